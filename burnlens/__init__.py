"""burnlens: user-acquisition analytics (creative burnout, cohorts, unit
economics, campaign saturation, SKAN reconciliation) on Spark DataFrames."""
