"""Filter interaction audit (operator 12): what each filter of a cascade removes
in every order of the filters.

Five filters run over whole texts (``FILTERS``): A to D look at the text alone,
E fails a text that equals one of a smaller doc_id anywhere in the table. Five
flags make a mask of 32 values, and every count of every order follows from the
number of documents of each mask: masks are additive, texts aren't needed again.

Method. *Counting-Bloom prepass*: each task counts its text hashes in a sketch
of two-bit counters that stop at 3; the sketches are added (``merged``) and the
sum goes to the executors. A text one of whose counters is below 2 is surely
unique in the table, so its flag E is clear without any shuffle. Only the
*possible repeats* are shuffled, grouped by their full text (after a map-side
aggregation, so a task sends each text once) for the least doc_id. A possible
repeat whose doc_id isn't that minimum fails E: its (hash, doc_id) joins the
minima, a join without hot keys, as each text has one minimum. Flags are then
counted by (part, mask), once for all documents and once for the labelled ones.
The 120 orders are read off the masks by exploding a fixed list of 600 steps.

Bounds. The sketch has ``COUNTERS_A_ROW`` counters a document, at most
``MAX_COUNTERS`` (2 bits each: 64 MB), so what is collected and broadcast never
exceeds 64 MB. Beyond 16 million documents the share of unique texts that are
shuffled as possible repeats grows; the results are the same. Sketches
are added in ``SEGMENT`` pieces by streaming over the rows of a partition, so no
task holds more than its pieces of one sketch.

Distinct words are counted by 64-bit hashes of random byte values within one text.

Contract cases: NULL text is the empty text (it fails A, and E behind a
smaller doc_id's empty text); B and C hold for no empty text (0 < 0). NULL source is the part ''
together with the empty source. A NULL doc_id is never smaller than another and
never fails E, and has no label. Rows of one doc_id count each; equal texts of the same
doc_id don't fail each other. A doc_id with several labels is good (toxic) if one
says so. An empty table gives no rows. Extra columns are ignored. A very long
text is one chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import materialise, mix, per_text_sum, span_hashes, text_chunks, word_spans

FILTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"
COUNTERS_A_ROW = 16
MAX_COUNTERS = 1 << 28
MIN_COUNTERS = 1 << 16
PROBES = 2
SEGMENT = 1 << 16  # bytes of a sketch in one row

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_POINT = np.ones(256, bool)  # bytes that start a code point
_POINT[0x80:0xC0] = False


# ------------------------------------------------------------ filters A to D
def distinct_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    own = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, first = np.unique(mix(hashes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(own[first], minlength=len(bounds) - 1)


def masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 of each text: it fails A, B, C, D."""
    starts, ends, bounds = word_spans(data, offsets)
    words = np.diff(bounds)
    distinct = distinct_words(span_hashes(data, starts, ends), bounds)
    upper, points = per_text_sum(_UPPER[data], offsets), per_text_sum(_POINT[data], offsets)
    symbols = per_text_sum(_SYMBOL[data], offsets)
    return ((words < MIN_WORDS) + 2 * (100 * distinct < 50 * words) + 4 * (100 * upper > 2 * points) + 8 * (symbols > 0)).astype(np.int32)


def _flags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("part"), rows.column("hash"), pa.array(masks(data, offsets))],
            names=["doc_id", "part", "hash", "mask"])


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.xxhash64(text).alias("hash"))


# ------------------------------------------------------------ counting Bloom sketch
def sketch_size(rows: int) -> int:
    """Counters for so many texts: a power of two, at most ``MAX_COUNTERS``."""
    return min(MAX_COUNTERS, max(MIN_COUNTERS, 1 << (rows * COUNTERS_A_ROW - 1).bit_length())) if rows else MIN_COUNTERS


def places(hashes: np.ndarray, size: int) -> np.ndarray:
    """(probes, texts): the counters of each text hash."""
    h = mix(hashes.view(np.uint64))
    return np.stack([(mix(h + np.uint64(k)) & np.uint64(size - 1)).astype(np.int64) for k in range(PROBES)])


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two sketches, packed four counters a byte; each counter stops at 3."""
    out = np.zeros_like(a)
    for shift in (0, 2, 4, 6):
        out |= np.minimum((a >> shift & 3) + (b >> shift & 3), 3) << shift
    return out


def _sketch(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sketch of one task's texts, as its segments that aren't empty."""
    packed = np.zeros(size // 4, np.uint8)
    for batch in batches:
        at, n = np.unique(places(np.asarray(batch.column(0)), size).ravel(), return_counts=True)
        byte, shift = at >> 2, (at & 3).astype(np.uint8) * 2
        n = np.minimum(n, 3).astype(np.uint8)
        for s in (0, 2, 4, 6):  # the counters at one place of their bytes: no byte twice
            of = shift == s
            b = byte[of]
            packed[b] = packed[b] & ~np.uint8(3 << s) | np.minimum((packed[b] >> s & 3) + n[of], 3) << s
    step = min(SEGMENT, len(packed))
    for k in range(len(packed) // step):
        piece = packed[k * step:(k + 1) * step]
        if piece.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([piece.tobytes()], pa.binary())], names=["segment", "counters"])


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            piece = np.frombuffer(raw.as_buffer(), np.uint8)
            total[k] = added(total[k], piece) if k in total else piece.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                     names=["segment", "counters"])


def merged(hashes: DataFrame, size: int) -> np.ndarray:
    """The packed sketch of all text hashes (one long column)."""
    schema = "segment int, counters binary"
    step = min(SEGMENT, size // 4)
    parts = hashes.mapInArrow(lambda b: _sketch(b, size), schema)
    out = np.zeros(size // 4, np.uint8)
    for row in parts.repartition(max(1, size // 4 // step // 4), "segment").mapInArrow(_add, schema).collect():  # size / 4 bytes at most
        out[row.segment * step:(row.segment + 1) * step] = np.frombuffer(bytes(row.counters), np.uint8)
    return out


def maybe_repeated(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each text hash may occur twice (no counter of it is below 2)."""
    at = places(hashes, len(packed) * 4)
    return ((packed[at >> 2] >> ((at & 3) * 2).astype(np.uint8) & 3) >= 2).all(0)


# ------------------------------------------------------------ flags
def flags(docs: DataFrame, size: int | None = None) -> DataFrame:
    """(doc_id, part, mask) of every document: bits 0 to 4 are filters A to E.
    ``size``: counters of the sketch, a power of two (default ``sketch_size``);
    it never changes a flag."""
    sc = docs.sparkSession.sparkContext
    src = _hashed(docs)
    own = materialise(src.mapInArrow(_flags, "doc_id long, part string, hash long, mask int"), "filter_flags")
    sketch = sc.broadcast(merged(own.select("hash"), size or sketch_size(own.count())))

    def possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(maybe_repeated(sketch.value, np.asarray(b.column("hash")))))
    repeats = src.select("doc_id", "text", "hash").where(F.col("doc_id").isNotNull()).mapInArrow(possible, "doc_id long, text string, hash long")
    minima = materialise(repeats.groupBy("text", "hash").agg(F.min("doc_id").alias("least"))
                         .select(F.col("hash").alias("__hash"), F.col("least").alias("__least")).distinct(), "least_ids")
    marked = own.mapInArrow(lambda bs: _marked(bs, sketch), "doc_id long, part string, hash long, mask int, maybe boolean")
    behind = (marked.where("maybe").join(minima, (F.col("hash") == F.col("__hash")) & (F.col("doc_id") == F.col("__least")), "left")
              .select("doc_id", "part", (F.col("mask") + F.when(F.col("__least").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)).alias("mask")))
    return materialise(behind.unionByName(marked.where("NOT maybe").select("doc_id", "part", "mask")), "filter_masks")


def _marked(batches: Iterable[pa.RecordBatch], sketch) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.append_column("maybe", pa.array(maybe_repeated(sketch.value, np.asarray(b.column("hash")))))


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): additive counts of documents."""
    told = (labels.groupBy(F.col("doc_id").cast("long").alias("__id"))
            .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good OR toxic"))
    seen = (flagged.join(told, F.col("doc_id") == F.col("__id")).groupBy("part", "mask")
            .agg(F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")).withColumn("n", F.lit(0).cast("long")))
    every = flagged.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return (every.select("part", "mask", "n", zero.alias("good"), zero.alias("toxic")).unionByName(seen)
            .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))


# ------------------------------------------------------------ orders
def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, mask of the filters before, the step's filter) of
    all orders."""
    out = []
    for p in permutations(filters):
        before = 0
        for k, f in enumerate(p):
            out.append(("".join(p), k + 1, before, 1 << filters.index(f)))
            before |= 1 << filters.index(f)
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per (part, filter_order, step) from ``mask_counts``."""
    n_orders = len(orders(filters)) // len(filters)
    steps = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(s).alias("s"), F.lit(b).alias("b"), F.lit(f).alias("f")) for o, s, b, f in orders(filters)])
    mask, before, own = F.col("mask"), F.col("x.b"), F.col("x.f")
    hit = mask.bitwiseAND(own) != 0
    gone = mask.bitwiseAND(before) != 0
    here = hit & ~gone
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    # a filter is the first of a mask's filters in an equal share of all orders
    share = F.when(hit, F.col("n") * F.lit(n_orders) / F.greatest(F.bit_count(mask), F.lit(1))).otherwise(0).cast("long")
    return (counts.withColumn("x", F.explode(steps)).groupBy("part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"))
            .agg(total("n", ~hit & ~gone).alias("kept"), total("n", here).alias("removed"), total("n", hit & gone).alias("redundant"),
                 total("n", mask == own).alias("unique_fails"), total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
                 F.sum(share).alias("shapley")))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    return audit(materialise(mask_counts(flags(docs), labels), "mask_counts"))
