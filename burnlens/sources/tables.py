"""Tables of the catalogue, published by one catalogue operation.

Every write makes a *version*: an external Parquet table of its own
(``db.name__<id>``) whose files go to a fresh folder. ``publish`` then points
the view ``db.name`` at it (ALTER VIEW, one change in the catalogue; CREATE OR
REPLACE VIEW would drop the view first). So a failed or repeated write leaves the published version as it was,
a reader sees one version, and of two writers one wins whole. Layout (month
partitions, buckets, sort order) is the version table's, so readers of the view prune
partitions and use buckets.

A version by month may share months with the published one: their partitions are
added at the folders where they are. The catalogue must outlive the session for that (a metastore); in
a session's own catalogue tables last as long as the session.

The version before the published one stays in the catalogue for readers that
have planned on it; older entries are dropped. Files are never deleted here, as newer
versions may share them.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnlens.functions.columns import month_key
from burnlens.session import scratch_path

MONTH = "ym"
NO_MONTH = "none"  # rows without a date
PREVIOUS = "burnlens.previous"  # of a view: the version before the published one


class NoTable(LookupError):
    """A name that nothing was published under."""


@dataclass(frozen=True)
class Layout:
    """``month_of``: partitions by month of this date column; ``by``: partitions by this column
    itself; ``sort``: order within each file; ``bucket``: (key or keys, number). ``dealt``: rows are
    written as they are dealt, without a shuffle (for rows that come from buckets: a file for each of them and month)."""
    month_of: str | None = None
    by: str | None = None
    sort: tuple[str, ...] = ()
    bucket: tuple[str | tuple[str, ...], int] | None = None
    dealt: bool = False

    @property
    def bucket_keys(self) -> tuple[str, ...]:
        keys = self.bucket[0] if self.bucket else ()
        return (keys,) if isinstance(keys, str) else keys

    @property
    def partition(self) -> str | None:
        return MONTH if self.month_of else self.by


@dataclass(frozen=True)
class Staged:
    """A version that is written but not published."""
    name: str
    version: str
    columns: tuple[str, ...]


# ------------------------------------------------------------ databases
def _checked(name: str, parts: int) -> list[str]:
    split = name.split(".")
    if len(split) != parts or not all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", p) for p in split):
        raise ValueError(f"not a name of {parts} parts: {name!r}")
    return split


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> str:
    """``location``: where its tables' files go (default: the warehouse)."""
    _checked(database, 1)
    at = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    return database


def scratch_database(spark: SparkSession, prefix: str = "scratch") -> str:
    """A new database under the shared checkpoint folder."""
    return create_database(spark, f"burnlens_{prefix}_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"db_{prefix}"))


# ------------------------------------------------------------ writing
def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Deal rows out by ``columns`` for a partitioned write: few files for each
    value, large values split, small ones merged (no sampling of the input)."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(columns)}) */ * FROM {{rows}}", rows=df)


def _create(spark: SparkSession, version: str, schema: T.StructType, layout: Layout) -> None:
    db, table = version.split(".")
    folder = f"{spark.catalog.getDatabase(db).locationUri}/{table.replace('__', '/v-')}"
    parts = [f"CREATE TABLE {version} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}) USING parquet OPTIONS ('compression' = 'zstd')"]
    if layout.partition:
        parts.append(f"PARTITIONED BY (`{layout.partition}`)")
    if layout.bucket:
        keys = ", ".join(f"`{k}`" for k in layout.bucket_keys)
        parts.append(f"CLUSTERED BY ({keys})" + (f" SORTED BY ({', '.join(f'`{c}`' for c in layout.sort)})" if layout.sort else "") + f" INTO {layout.bucket[1]} BUCKETS")
    spark.sql(" ".join([*parts, f"LOCATION {_quoted(folder)}"]))


def stage(df: DataFrame, name: str, layout: Layout = Layout(), keep: dict[str, str] | None = None,
          observe: tuple[Observation, list[Column]] | None = None) -> Staged:
    """Write ``df`` as a version of the table ``name`` that isn't visible yet.
    ``keep``: months (with their folders) that the version shares with another.
    ``observe``: metrics of the rows, taken in the writing tasks themselves, so a
    repeated task counts once."""
    spark = df.sparkSession
    _checked(name, 2)
    rows, p = df, layout.partition
    if layout.month_of:
        rows = df.withColumn(MONTH, F.coalesce(month_key(layout.month_of), F.lit(NO_MONTH)))
    columns = [c for c in rows.columns if c != p] + ([p] if p else [])
    rows = rows.select(columns)
    staged = Staged(name, f"{name}__{uuid.uuid4().hex[:16]}", tuple(df.columns) + ((MONTH,) if layout.month_of else ()))
    _create(spark, staged.version, rows.schema, layout)
    try:
        if layout.bucket:
            rows = rows.repartition(layout.bucket[1], *layout.bucket_keys)
        else:
            rows = rebalance(rows, p) if p and not layout.dealt else rows
            order = [*([p] if p else []), *layout.sort]
            rows = rows.sortWithinPartitions(*order) if order else rows
        if observe:
            rows = rows.observe(observe[0], *observe[1])
        rows.write.insertInto(staged.version)
        if keep:
            added = " ".join(f"PARTITION (`{p}`={_quoted(k)}) LOCATION {_quoted(path)}" for k, path in sorted(keep.items()))
            spark.sql(f"ALTER TABLE {staged.version} ADD {added}")
        if p:  # file sizes for the planner's choice of joins; a table without partitions has them anyway
            spark.sql(f"ANALYZE TABLE {staged.version} COMPUTE STATISTICS NOSCAN")
    except BaseException:
        discard(spark, staged)
        raise
    return staged


def discard(spark: SparkSession, staged: Staged) -> None:
    """Take a version that won't be published off the catalogue."""
    spark.sql(f"DROP TABLE IF EXISTS {staged.version}")


def _previous(spark: SparkSession, name: str) -> str | None:
    for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if r["key"] == PREVIOUS:
            return r["value"]
    return None


def publish(spark: SparkSession, staged: Staged) -> None:
    """Make the version the one that readers of the name see."""
    name, columns = staged.name, ", ".join(f"`{c}`" for c in staged.columns)
    rows = f"SELECT {columns} FROM {staged.version}"
    held = version(spark, name) if exists(spark, name) else None
    if held is None:
        spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {rows}")
    if version(spark, name) != staged.version:
        spark.sql(f"ALTER VIEW {name} AS {rows}")
    if held is not None:
        gone = _previous(spark, name)
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{held}')")
        if gone and gone not in (held, version(spark, name)):
            spark.sql(f"DROP TABLE IF EXISTS {gone}")


def replace(df: DataFrame, name: str, layout: Layout = Layout(), keep: dict[str, str] | None = None) -> None:
    """Write a version and publish it."""
    publish(df.sparkSession, stage(df, name, layout, keep))


# ------------------------------------------------------------ reading
def exists(spark: SparkSession, name: str) -> bool:
    db, _ = _checked(name, 2)
    return spark.catalog.databaseExists(db) and spark.catalog.tableExists(name)


def version(spark: SparkSession, name: str) -> str:
    """The version table behind a published name."""
    if not exists(spark, name):
        raise NoTable(name)
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if r["col_name"] == "View Text" and (found := re.search(rf" FROM ({re.escape(name)}__[0-9a-f]+)$", r["data_type"])):
            return found[1]
    raise NoTable(f"{name} wasn't published here")


def _cut(df: DataFrame, since: dt.date | None, date_col: str | None) -> DataFrame:
    if since is not None:
        if MONTH in df.columns:
            df = df.where((F.col(MONTH) >= since.strftime("%Y%m")) & (F.col(MONTH) < NO_MONTH))
        df = df.where(F.col(date_col) >= F.lit(since))
    return df.drop(MONTH)


def read(spark: SparkSession, name: str, since: dt.date | None = None, date_col: str | None = None) -> DataFrame:
    """The published rows, without the month column. With ``since``, those dated on or after it:
    earlier months' partitions are pruned, the date predicate skips row groups."""
    if not exists(spark, name):
        raise NoTable(name)
    return _cut(spark.table(name), since, date_col)


def read_staged(spark: SparkSession, staged: Staged, since: dt.date | None = None, date_col: str | None = None) -> DataFrame:
    """The rows of a version that isn't published yet."""
    return _cut(spark.table(staged.version).select(*staged.columns), since, date_col)


def partitions(spark: SparkSession, version_table: str) -> list[str]:
    """Values of the partition column."""
    return [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {version_table}").collect()]


def months_before(spark: SparkSession, name: str, since: dt.date) -> dict[str, str]:
    """Folder of each month of the published version that ends before ``since``'s month."""
    held = version(spark, name)
    return {m: folder(spark, held, m) for m in partitions(spark, held) if m < since.strftime("%Y%m")}


def folder(spark: SparkSession, version_table: str, month: str) -> str:
    """Where a month's files are."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {version_table} PARTITION (`{MONTH}`={_quoted(month)})").collect()
    return next(r["data_type"] for r in told if r["col_name"] == "Location")


def latest(spark: SparkSession, version_table: str, date_col: str) -> dt.date | None:
    """max(date) of a version by month, read from its newest month only."""
    held = [m for m in partitions(spark, version_table) if m != NO_MONTH]
    if not held:
        return None
    return spark.table(version_table).where(F.col(MONTH) == max(held)).agg(F.max(date_col).alias("m")).first()["m"]
