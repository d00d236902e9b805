"""Uniqueness over many loads: Bloom filters of the loaded keys.

A month part's keys are kept as a Bloom filter next to the table: bits in
rows of 32,768 (``part``, ``bucket``, ``bits``). All bits of a key lie in one bucket. When new rows come, their keys
probe the filters of the parts that stay; only keys with all bits set are possible repeats, and only
those meet the stored keys exactly. So a load is checked by reading its own keys, the filters (some 2 bytes
a key) and, if there are candidates, the stored key column against that short list.

Everything is built-in functions: the keys' distinct hashes are dealt out by bucket, where
``bitmap_construct_agg`` collects their bits, and parts are added by ``bitmap_or_agg``. What is shuffled is a
hash a key (a bitmap sent by each task that has a bit of it would grow with tasks times buckets). No row holds more
than one 4 KB bucket, and a hot key is one hash before the shuffle.

The result is exact: a Bloom filter misses no key that it holds, and the
candidates are counted in the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32768  # of a bitmap of the built-in functions
BITS_A_KEY = 16
PROBES = 4
FILTER = "part string, bucket long, bits binary"
COUNTED = "key string, n long"


def bucket_count(keys: int) -> int:
    """Buckets for so many keys: a power of two."""
    need = max(1, -(-keys * BITS_A_KEY // BUCKET_BITS))
    return 1 << (need - 1).bit_length()


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("long")


def _bits(h: Column) -> list[Column]:
    """The places in its bucket of a key with this hash."""
    return [F.pmod(F.xxhash64(h, F.lit(k)), F.lit(BUCKET_BITS)) for k in range(PROBES)]


def build(keys: DataFrame, buckets: int) -> DataFrame:
    """The filters (FILTER) of keys given as (part, key); NULL keys have no bits."""
    hashed = keys.where(F.col("key").isNotNull()).select("part", F.xxhash64("key").alias("h")).distinct()
    dealt = hashed.withColumn("bucket", _bucket(F.col("h"), buckets)).repartition("part", "bucket")
    each = dealt.groupBy("part", "bucket").agg(*[F.bitmap_construct_agg(b).alias(f"b{k}") for k, b in enumerate(_bits(F.col("h")))])
    return (each.select("part", "bucket", F.explode(F.array(*[f"b{k}" for k in range(PROBES)])).alias("bits"))
            .groupBy("part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def possible_repeats(keys: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct ``keys`` (column key) that may be in one of the filters."""
    held = filters.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    new = keys.where(F.col("key").isNotNull()).select("key").distinct().withColumn("__h", F.xxhash64("key"))
    found = new.withColumn("bucket", _bucket(F.col("__h"), buckets)).join(held, "bucket")
    for bit in _bits(F.col("__h")):
        found = found.where(_is_set(F.col("bits"), bit))
    return found.select("key")


def counted(keys: DataFrame) -> DataFrame:
    """COUNTED of a column key, without NULLs; combined before the shuffle."""
    return keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def repeated(new: DataFrame, kept: DataFrame, filters: DataFrame, before: DataFrame, buckets: int) -> DataFrame:
    """COUNTED of the keys that occur more than once in ``new`` and ``kept``
    together (columns key). ``filters``: those of the kept parts. ``before``:
    the repeated keys of the table before ``new`` came; each is counted again, as rows of it may have been
    replaced. So a repeat lies within ``new``, between ``new`` and ``kept`` (a candidate) or was known."""
    mine = counted(new)
    candidates = possible_repeats(new, filters, buckets).unionByName(before.select("key")).distinct()
    there = counted(kept.join(candidates, "key", "left_semi"))
    return mine.unionByName(there).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
