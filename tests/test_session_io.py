"""Session helpers and the BI type contract."""

from pyspark.sql import types as T

from burnlens.session import checkpoint_root, cluster_conf, scratch_path
from burnlens.sources import files


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root and checkpoint_root(spark) == root            # read, not re-created
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)  # a fresh path per use


def test_cluster_conf_scales_with_cores():
    small, big = cluster_conf(8), cluster_conf(8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 24000
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_bi_type_contract(models):
    out = files.bi_types(models.mart_creative_burnout).schema
    kinds = {f.name: type(f.dataType) for f in out.fields}
    for c in ("stat_date", "launch_date", "burnout_date"):
        assert kinds[c] is T.DateType
    for c in ("is_video", "is_post_burnout"):
        assert kinds[c] is T.BooleanType
    for c in ("burnout_score", "ctr", "ctr_7d_avg", "cpi_usd", "ctr_vs_peak_ratio"):
        assert kinds[c] is T.DoubleType
    for c in ("lifecycle_stage", "format", "creative_id"):
        assert kinds[c] is T.StringType
