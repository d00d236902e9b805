"""Mixing sources to target weights (operator 13).

All sources' words are dealt into a mix of ``SHARE`` times the corpus. Sources in
code-point order (NULL last) weigh ``WEIGHTS``, repeating; a source's target
stops at ``LIMIT`` times its size, and the excess goes to the others by weight until
none is above.

Method. The words of a source, document after document, are one stream that is
packed into blocks of ``BLOCK`` words (the last may be shorter). The mix is a row
of slots, one block each, cut into output shards. For each shard the numbers of
slots of the sources are drawn from a multinomial over what the sources still
have to give, so they add up to every source's slots and all shards look alike.
The i-th slot of a source takes block ``perm(i mod blocks)``, where ``perm`` is a
pseudorandom permutation of that source and epoch (a Feistel network with cycle
walking, so no permutation is stored); the order of slots in a shard is another.
Slots and blocks are then joined by (source, block). A source's last slot is cut to
meet the target to the word, so no block, and no document, is taken more than
``LIMIT`` times. All draws come from ``seed``: reruns agree, whatever the
partitioning.

Spark: sizes are counted in the tasks that read the texts; places in the
streams come from sums of (source, bucket) and a running sum within each bucket
of about ``BUCKET_ROWS`` documents, so a source with a third of all rows is many
buckets. Slots are generated from a range by the tasks, and (source, block) has
no hot keys. Only source totals and the draws (shards x sources numbers, set by the
parameters) are on the driver; the draws go out as a closure of that size.

Contract cases: NULL text has no words; documents without words take nothing. A
source without words keeps its place in the weights, with target 0. NULL and the
empty source are two sources. NULL, repeated or tied doc_ids: every row is a document of its
own; rows that agree in doc_id and text share a place in the order, so it doesn't matter
which comes first. An empty table gives an empty mix. Extra columns are ignored. A
very long document is a run of blocks, made one by one. A source of fewer than
``BLOCK`` words is one short block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burnlens.llm.common import materialise, mix as mixed, text_chunks, word_spans

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
LIMIT = 2
BLOCK = 64
SHARDS = 256
SEED = 20240607
BUCKET_ROWS = 5_000
SLOTS_A_TASK = 1 << 18
ROUNDS = 6
ROUND_KEYS = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------ targets
def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, limit: int = LIMIT) -> list[Fraction]:
    """Words to take of each source (sizes in source order)."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    total, out = share * sum(sizes), [Fraction(0)] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        left = total - sum(out[k] for k in range(len(sizes)) if k not in free)
        unit = left / sum(weight[k] for k in free)
        over = [k for k in free if unit * weight[k] > limit * sizes[k]]
        for k in over or free:
            out[k] = Fraction(limit * sizes[k]) if over else unit * weight[k]
        free = [k for k in free if k in over] and [k for k in free if k not in over]
    return out


# ------------------------------------------------------------ pseudorandom permutations
def _bits(n: np.ndarray) -> np.ndarray:
    """Half the bits of the least even-bit domain that holds n values."""
    half = np.ones(len(n), np.uint64)
    while (small := (np.uint64(1) << (half * np.uint64(2))) < n).any():
        half[small] += np.uint64(1)
    return half


def _feistel(x: np.ndarray, key: np.ndarray, half: np.ndarray, inverse: bool) -> np.ndarray:
    low = (np.uint64(1) << half) - np.uint64(1)
    a, b = x >> half, x & low
    for r in range(ROUNDS)[::-1] if inverse else range(ROUNDS):
        salt = key + ROUND_KEYS[r]
        if inverse:
            a, b = b ^ (mixed(a + salt) & low), a
        else:
            a, b = b, a ^ (mixed(b + salt) & low)
    return a << half | b


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Elementwise: the place of x in the permutation ``key`` of 0 .. n - 1."""
    x, n, key = (np.array(v, np.uint64) for v in (x, n, key))
    half = _bits(n)
    out = _feistel(x, key, half, inverse)
    while (again := np.flatnonzero(out >= n)).size:  # walk the cycle back into the domain
        out[again] = _feistel(out[again], key[again], half[again], inverse)
    return out.astype(np.int64)


def _key(seed: int, *parts: np.ndarray) -> np.ndarray:
    h = np.array([seed], np.uint64)
    for p in parts:
        h = mixed(h * np.uint64(0x2545F4914F6CDD1D) + np.asarray(p).astype(np.uint64) + np.uint64(1))
    return h


# ------------------------------------------------------------ the plan of a mix
@dataclass(frozen=True)
class Plan:
    """Sources' sizes, targets, blocks, slots and the words of their last slot;
    ``first`` is the first slot of each (shard, source) run (and the total at the
    end), ``nth`` the source's number of that slot."""
    sources: tuple[str | None, ...]
    sizes: np.ndarray
    targets: tuple[float, ...]
    blocks: np.ndarray
    slots: np.ndarray
    cut: np.ndarray
    first: np.ndarray
    nth: np.ndarray
    block: int
    seed: int

    @property
    def total(self) -> int:
        return int(self.first[-1])


def slots_for(words: int, size: int, block: int, key) -> tuple[int, int]:
    """Slots that hold ``words`` words of a source of ``size`` words, and the
    words of the last one. ``key(epoch)`` names the epoch's permutation."""
    if not words:
        return 0, 0
    blocks = -(-size // block)
    tail = size - (blocks - 1) * block
    epoch, rest = divmod(words - 1, size)
    rest += 1  # 1 .. size words of the last epoch
    at = int(permute([blocks - 1], [blocks], key(epoch), inverse=True)[0])  # where that epoch has the short block
    if rest <= at * block:
        n = -(-rest // block)
        return epoch * blocks + n, rest - (n - 1) * block
    rest -= at * block
    if rest <= tail:
        return epoch * blocks + at + 1, rest
    n = -(-(rest - tail) // block)
    return epoch * blocks + at + 1 + n, rest - tail - (n - 1) * block


def draws(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources): multinomial counts over the slots that the sources
    have left, for shards of equal length; they add up to ``slots``."""
    left = np.array(slots, np.int64)
    total, rng = int(left.sum()), np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        n = total * (k + 1) // shards - total * k // shards
        got = np.zeros(len(slots), np.int64)
        while got.sum() < n:  # what a source lacks is drawn again from the others
            rest = left - got
            got = np.minimum(got + rng.multinomial(n - int(got.sum()), rest / rest.sum()), left)
        out[k], left = got, left - got
    return out


def plan(totals: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, limit: int = LIMIT,
         block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> Plan:
    sources = tuple(sorted((s for s in totals if s is not None))) + ((None,) if None in totals else ())
    sizes = [totals[s] for s in sources]
    goal = targets(sizes, weights, share, limit)
    held = [slots_for(int(t + Fraction(1, 2)), n, block, lambda e, k=k: _key(seed, [k], [e])) for k, (t, n) in enumerate(zip(goal, sizes))]
    slots = [n for n, _ in held]
    counts = draws(slots, max(1, min(shards, sum(slots))), seed)
    return Plan(sources, np.array(sizes, np.int64), tuple(float(t) for t in goal), np.array([-(-n // block) for n in sizes], np.int64),
                np.array(slots, np.int64), np.array([c for _, c in held], np.int64),
                np.concatenate([[0], np.cumsum(counts.ravel())]), (np.cumsum(counts, 0) - counts).ravel(), block, seed)


def slot_rows(g: np.ndarray, p: Plan) -> dict[str, np.ndarray]:
    """shard, slot, source, block, words of the slots numbered ``g``."""
    run = np.searchsorted(p.first, g, "right") - 1
    n_sources = len(p.sources)
    source, shard = run % n_sources, run // n_sources
    nth = p.nth[run] + g - p.first[run]
    blocks = p.blocks[source]
    block = permute(nth % blocks, blocks, _key(p.seed, source, nth // blocks))
    words = np.minimum(p.block, p.sizes[source] - block * p.block)
    words = np.where(nth == p.slots[source] - 1, np.minimum(words, p.cut[source]), words)
    start, end = p.first[shard * n_sources], p.first[(shard + 1) * n_sources]
    slot = permute(g - start, end - start, _key(p.seed ^ 0xFFFF, shard))
    return {"shard": shard, "slot": slot, "source_no": source, "block": block, "words": words}


# ------------------------------------------------------------ Spark
def _sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        size = np.diff(word_spans(data, offsets)[2]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("doc_id", "source", "text_hash")], pa.array(size)],
                                         names=["doc_id", "source", "text_hash", "size"])


def _placed(docs: DataFrame) -> tuple[DataFrame, dict[str | None, int]]:
    """doc_id, source, text_hash, size, start (words of the source before the
    document) of all rows, and the sources' sizes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"),
                      F.xxhash64(text).alias("text_hash"))
    sized = materialise(src.mapInArrow(_sizes, "doc_id long, source string, text_hash long, size long"), "mix_sizes")
    buckets = sized.count() // BUCKET_ROWS + 1
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    held = materialise(sized.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "mix_buckets")
    before = held.select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"),
                         (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (sized.withColumn("upto", F.sum("size").over(inside))
              .join(before, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
              .select("doc_id", "source", "text_hash", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("start")))
    return materialise(placed, "mix_places"), {r.source: r.n for r in held.groupBy("source").agg(F.sum("n").alias("n")).collect()}


def _numbered(placed: DataFrame, p: Plan) -> DataFrame:
    """``placed`` with source_no, source_size and target: a join with one row a source."""
    rows = [(s, k, int(p.sizes[k]), p.targets[k]) for k, s in enumerate(p.sources)]
    named = placed.sparkSession.createDataFrame(rows, "__source string, source_no int, source_size long, target double")
    return placed.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def block_pieces(numbered: DataFrame, block: int) -> DataFrame:
    """source_no, block, start (the document's), at (the piece's first word in the block), word (its
    first word in the document), n: which words of which documents a block holds."""
    end = F.col("start") + F.col("size")
    lo = F.greatest(F.col("start"), F.col("block") * block)
    return (numbered.where("size > 0")
            .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
            .select("source_no", "block", "doc_id", "text_hash", "start", (lo - F.col("block") * block).alias("at"), (lo - F.col("start")).alias("word"),
                    (F.least(end, (F.col("block") + 1) * block) - lo).alias("n")))


def slots(spark, p: Plan) -> DataFrame:
    """shard, slot, source_no, block, words (of the block that the slot takes)."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = slot_rows(np.asarray(b.column(0)), p)
            yield pa.RecordBatch.from_arrays([pa.array(out[c].astype(t)) for c, t in kinds.items()], names=list(kinds))
    kinds = {"shard": np.int32, "slot": np.int64, "source_no": np.int32, "block": np.int64, "words": np.int32}
    tasks = p.total // SLOTS_A_TASK + 1
    return spark.range(0, p.total, 1, tasks).mapInArrow(rows, "shard int, slot long, source_no int, block long, words int")


def mix(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """The mix and its documents. The mix has one row per piece: shard, slot,
    at (the piece's first word in the slot), doc_id, text_hash, word (its first word in the
    document), n (words), source_no, start; sorted by (shard, slot, at) it is the token order.
    The documents: doc_id, source, text_hash, size, start, source_no, source_size, target.
    ``how``: parameters of ``plan``."""
    placed, totals = _placed(docs)
    p = plan(totals, **how)
    numbered = _numbered(placed, p)
    if not p.total:
        none = "shard int, slot long, at long, doc_id long, text_hash long, word long, n long, source_no int, start long"
        return docs.sparkSession.createDataFrame([], none), numbered
    taken = slots(docs.sparkSession, p).join(block_pieces(numbered, p.block), ["source_no", "block"]).where(F.col("at") < F.col("words"))
    return taken.select("shard", "slot", "at", "doc_id", "text_hash", "word", F.least(F.col("n"), F.col("words") - F.col("at")).alias("n"),
                        "source_no", "start"), numbered


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "slot", "at", "text"]
    for b in batches:
        for rows, data, offsets in text_chunks([b]):
            starts, ends, bounds = word_spans(data, offsets)
            out: list[tuple] = []
            for k, pieces in enumerate(rows.column("pieces").to_pylist()):
                for x in pieces:
                    lo = bounds[k] + x["word"]
                    out.append((x["shard"], x["slot"], x["at"], b" ".join(data[s:e].tobytes() for s, e in
                                                                         zip(starts[lo:lo + x["n"]], ends[lo:lo + x["n"]])).decode("utf-8")))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=names)


def texts(docs: DataFrame, mixed_pieces: DataFrame) -> DataFrame:
    """shard, slot, at, text: the words of every piece of a mix, one space
    apart. Pieces go to their document in lists by runs of its words, so a list
    is bounded and a long document's text is joined once for each."""
    listed = (mixed_pieces.groupBy("doc_id", "text_hash", "source_no", "start", F.expr("word div 64000").alias("run"))
              .agg(F.collect_list(F.struct("shard", "slot", "at", "word", "n")).alias("pieces")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = (docs.select(F.col("doc_id").cast("long").alias("__id"), text.alias("text"), F.xxhash64(text).alias("__hash"))
           .dropDuplicates(["__id", "__hash"]))
    return (listed.join(src, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).select("text", "pieces")
            .mapInArrow(_cut, "shard int, slot long, at long, text string"))


def taken(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of
    each document, repeats counted."""
    pieces, documents = mix(docs, **how)
    words = pieces.groupBy(F.col("source_no").alias("__no"), F.col("start").alias("__start")).agg(F.sum("n").alias("n"))
    return (documents.join(words, (F.col("size") > 0) & (F.col("source_no") == F.col("__no")) & (F.col("start") == F.col("__start")), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("taken")))
