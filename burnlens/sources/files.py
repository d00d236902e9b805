"""File sources and sinks: typed CSV ingest, idempotent replace, month
partitioning, sorted layout, BI exports.

Every replace writes a new version of a catalogue table and then publishes it
(see ``tables``), so a lost executor or a failed job leaves the previous version
intact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnlens.functions.columns import month_key, nan_to_null
from burnlens.sources import tables
from burnlens.sources.schemas import MONTH_PARTITION, RAW_SCHEMAS, SORT_KEYS

MONTH_COLUMN = tables.MONTH


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, types by the declared schema (src_schema)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def api_edge(df: DataFrame) -> DataFrame:
    """Money is DECIMAL(18,4) in storage and double at the API edge."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header; columns typed by the declared schema, never inferred.
    FAILFAST: a malformed row fails the load instead of becoming NULLs."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


BAD_LINE = "_bad_line"
REJECTED = "table_name string, file string, line string, parsed string"


class TooManyBadLines(ValueError):
    """More lines than allowed aren't rows of their table; nothing was loaded."""


def _raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every line of a raw table's CSV files: columns matched by name (the header
    gives their order), BAD_LINE the line itself if it isn't a row of them. A missing
    column is an error, and so is a file with another header than the first."""
    wanted = RAW_SCHEMAS[table]
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"{table}: the CSV files at {path} have no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in wanted}
    given = T.StructType([*[T.StructField(c, types.get(c, T.StringType()), True) for c in header], T.StructField(BAD_LINE, T.StringType(), True)])
    return (spark.read.schema(given).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_LINE).csv(path))


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The good rows of a raw table's CSV files; ``rejected_lines`` has the others."""
    return _raw_csv(spark, path, table).where(F.col(BAD_LINE).isNull()).select(*RAW_SCHEMAS[table].fieldNames())


def rejected_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """REJECTED: lines with a wrong number of values, or a value not of its
    column's type; ``parsed`` is what could be read of them, as JSON (all columns are
    read, as only those are checked)."""
    rows = _raw_csv(spark, path, table)
    parsed = F.to_json(F.struct(*[c for c in rows.columns if c != BAD_LINE]))
    return (rows.select("*", F.col("_metadata.file_path").alias("file")).where(F.col(BAD_LINE).isNotNull())
            .select(F.lit(table).alias("table_name"), "file", F.col(BAD_LINE).alias("line"), parsed.alias("parsed")))


def with_loaded_at(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Audit timestamp of the load (src_loaded_at)."""
    return df.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def write_replace(df: DataFrame, name: str) -> None:
    """Idempotent full replace of the table ``name`` (sink_replace)."""
    tables.replace(df, name)


def write_month_partitioned(df: DataFrame, path: str, date_col: str) -> None:
    """Facts partitioned by month of ``date_col`` (sink_partition_month).
    Month, not day: few, large files; readers prune on ``ym`` or on the date."""
    (tables.rebalance(df.withColumn(MONTH_COLUMN, month_key(date_col)), MONTH_COLUMN)
     .write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path))


def read_month_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(MONTH_COLUMN, T.StringType(), True)])
    return spark.read.schema(full).parquet(path)


def write_sorted(df: DataFrame, path: str, keys) -> None:
    """Sort within each output file by the table's key (sink_sorted): parquet
    min/max statistics then skip row groups on key and date predicates.
    No global sort, so no range shuffle."""
    df.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def raw_layout(table: str) -> tables.Layout:
    """Facts in month partitions, every table sorted by its key within files.
    The rows are rebalanced by month: AQE merges small months into few tasks and
    splits large ones, so the number of files follows the data, and the input is read once."""
    return tables.Layout(month_of=MONTH_PARTITION[table], sort=SORT_KEYS[table])


def read_raw_table(spark: SparkSession, database: str, table: str, since=None) -> DataFrame:
    """A loaded raw table, without load columns. With ``since`` (a date), fact
    tables keep only rows dated on or after it, and earlier months are pruned."""
    date_col = MONTH_PARTITION[table]
    df = tables.read(spark, f"{database}.{table}", since if date_col else None, date_col)
    return df.select(*RAW_SCHEMAS[table].fieldNames())


def load_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nan_free(df: DataFrame) -> DataFrame:
    """NaN / Inf to NULL in every floating column (CSV readers reject them)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def export_csv(df: DataFrame, path: str) -> None:
    """Mart as CSV with header for BI (sink_export_csv)."""
    nan_free(df).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """Mart as one JSON object per line (sink_export_json)."""
    nan_free(df).write.mode("overwrite").json(path)


# BI column-type contract: dates, decimal numbers, booleans, text.
_DATE = re.compile(r"^(stat_date|install_date|launch_date|burnout_date|stat_week|install_week)$")
_NUMBER = re.compile(r"^(burnout_score|ltv_.*|roas.*|cac_usd|cpi_.*|ctr.*|.*_rate|.*_usd)$")
_BOOL = re.compile(r"^is_.*$")
_TEXT = re.compile(r"^(lifecycle_stage|saturation_flag|payback_.*|format.*|.*_id|.*_name|network|country)$")


def bi_types(df: DataFrame) -> DataFrame:
    """Final projection with an explicit cast per column (sink_bi_types)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if _DATE.match(f.name):
            c = c.cast("date")
        elif _BOOL.match(f.name):
            c = c.cast("boolean")
        elif _NUMBER.match(f.name) and isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
        elif _TEXT.match(f.name):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(out)
