"""Business rules of the user-acquisition models.

Fixed values: everything in this module must equal the reference's
definitions for results to agree. They are stated here once, as plain data,
and every operator reads them from here.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Model variables.
BURNOUT_CTR_THRESHOLD = 0.70          # 7-day CTR below 70 % of peak = burnt
MIN_IMPRESSIONS_FOR_BURNOUT = 500     # days with fewer impressions are ignored
COHORT_DAYS = (1, 3, 7, 14, 30)       # cohort checkpoints (plus day 0)
REPROCESS_DAYS = 14                   # incremental look-back of the burnout mart
BACKFILL_DAYS = 45                    # weekly cohort backfill window

# Accepted values of the raw tables.
NETWORKS = ("Meta", "Google_UAC", "Apple_Search_Ads", "TikTok", "Snap")
FORMATS = ("video_15s", "video_30s", "static_image", "carousel")
SKAN_VERSIONS = ("3.0", "4.0")
PRIVACY_THRESHOLDS = ("none", "low", "medium")
EVENT_TYPES = ("trial_start", "subscription_start", "subscription_renew", "purchase")
OBJECTIVES = ("app_installs", "app_purchases")
COUNTRIES = ("US", "GB", "AU", "CA", "DE", "FR")
SIZES = ("9x16", "1x1", "4x5")

# Creative format -> format group; anything else is "other".
FORMAT_GROUPS = (
    ("video_15s", "video"),
    ("video_30s", "video"),
    ("static_image", "static"),
    ("carousel", "carousel"),
)
VIDEO_LENGTHS = (("video_15s", 15), ("video_30s", 30))

# IAP product -> tier (else "other") and monthly-equivalent factor (else x1).
PRODUCT_TIERS = (
    ("weekly_sub", "weekly"),
    ("monthly_sub", "monthly"),
    ("annual_sub", "annual"),
    ("lifetime", "lifetime"),
)
MONTHLY_EQUIVALENT = (
    ("weekly_sub", "mul", 4.33),
    ("monthly_sub", "mul", 1.0),
    ("annual_sub", "div", 12.0),
    ("lifetime", "div", 24.0),
)

# SKAN conversion value (0..63) -> bucket, inclusive ranges, no else.
CV_BUCKETS = (
    (0, 0, "no_event"),
    (1, 2, "engagement"),
    (3, 3, "trial_start"),
    (4, 7, "low_revenue"),
    (8, 15, "mid_revenue"),
    (16, 63, "high_revenue"),
)
# SKAN conversion value -> estimated revenue; above 15: (cv - 15) * 3.0 + 99.99.
CV_REVENUE = (
    (0, 3, 0.0),
    (4, 5, 9.99),
    (6, 7, 14.99),
    (8, 11, 29.99),
    (12, 13, 49.99),
    (14, 15, 79.99),
)
CV_REVENUE_ABOVE_BASE = 15
CV_REVENUE_STEP = 3.0
CV_REVENUE_OFFSET = 99.99
CV_REVENUE_SIGNAL_MIN = 4             # cv >= 4 carries a revenue signal
FINE_PRIVACY = "none"                 # privacy 'none' = fine, else coarse

# Campaign saturation: cpi_trend_ratio thresholds, checked in this order.
SATURATING_ABOVE = 1.30
WATCH_ABOVE = 1.15
IMPROVING_BELOW = 0.90
OVER_BUDGET_ABOVE = 1.05

# Payback period labels (note the "≤" and the en dash).
PAYBACK_BUCKETS = ("≤ 7 days", "8–14 days", "15–30 days", "> 30 days")
PAID_BACK, NOT_YET = "paid_back", "not_yet"

# Lifecycle stages of a creative.
STAGES = ("warming_up", "peak", "declining", "burnt")
# ------------------------------------------------------------ end fixed values
