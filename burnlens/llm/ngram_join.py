"""N-gram Jaccard join by prefix trees (operator 6).

A document is the set of its distinct word n-grams, as 64-bit hashes in one
global order. Two sets link when their Jaccard similarity is at least
PERCENT / 100. The join is exact:

1. Documents with equal sets (128-bit fingerprint) are one node.
2. Star links: sets with a min-hash in common are compared with the one of
   least id among them. Most near copies become one component here, so that
   large groups of them need no further comparison.
3. Prefix filter: linked sets share an n-gram among the first
   n - ceil(PERCENT% n) + 1 of either. The order is by a fixed table of hashed counts
   over all sets, rare n-grams first, so that few prefixes hold frequent ones (any one
   order is right). N-grams whose sets all lie in one
   component are done. For the others the sets that share one are paired, by
   position and length bounds, where they lie in different components and
   their parity signatures allow a link: a bit tells whether the set has an
   odd number of the n-grams that hash there, so each bit in which two
   signatures differ is an n-gram that only one set has. N-grams
   of more than LIGHT sets (passages that many documents share) pair nothing:
   the documents that hold them go through the step again with these n-grams
   last in the order, which leaves their prefixes to rarer ones.
4. Candidates are verified in prefix trees: the partners of a set are sorted,
   so that those with a common beginning are neighbours; the overlap over the
   common beginning is counted once, and a branch is left as soon as the
   overlap so far plus what remains of either set is too small.
5. Components of all links.

Before a pair's sets are compared, bitmaps of a few bits per n-gram do: each bit in
which two differ is an n-gram that the sets don't share, which bounds the
overlap from above. Only documents in candidate pairs are read again.

Contract cases: texts without words (NULL, empty, white space) have an empty
set and link with nothing; texts of fewer than n words have one n-gram, the
whole sequence; repeated rows give a row each, with the same component; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import (BYTE_VALUES, LOWER_VALUES, id_text, materialise, mix, shingle_hashes,
                                 span_hashes, text_chunks, word_spans)
from burnlens.llm.graph import components

WORDS, PERCENT = 4, 85
HASHES = 6
AGREE = 4             # of HASHES, for a star link to be worth a comparison
LIGHT = 64
FOLD = 4              # words that every signature is folded to, for a first bound
SIGNATURE = 16        # words of a signature at most: it travels with every posting
COUNTERS = 1 << 20    # of hashed n-gram counts, whatever the number of n-grams
BROADCAST_IDS = 1_000_000      # at most 8 MB of ids go to the executors; beyond, a shuffled join
BROADCAST_GRAMS = 1_000_000


class Measure:
    """Integer bounds of the similarity test."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.percent * n + 99) // 100 + 1

    def overlap(self, n: int, m: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def sizes(self, n: Column, m: Column) -> Column:
        return 100 * F.least(n, m) >= self.percent * F.greatest(n, m)


def gram_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, and bounds by text."""
    starts, ends, bounds = word_spans(data, offsets)
    grams, at = shingle_hashes(span_hashes(data, starts, ends, LOWER_VALUES), bounds, words)
    parts = [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:])]
    return (np.concatenate(parts) if parts else grams), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _describe(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    keys = [np.uint64(int(BYTE_VALUES[k]) | 1) for k in range(HASHES)]
    for rows, data, off in text_chunks(batches):
        g, at = gram_sets(data, off, words)
        n = np.diff(at)
        some = n > 0
        first = at[:-1][some]
        full = lambda v: np.where(some, _spread(v, some), np.uint64(0))
        a = full(np.add.reduceat(mix(g ^ np.uint64(0x5DEECE66D)), first)) if some.any() else np.zeros(len(n), np.uint64)
        b = full(np.add.reduceat(mix(g * np.uint64(0x9E3779B97F4A7C15) + np.uint64(11)), first)) if some.any() else a
        low = [full(np.minimum.reduceat(mix(g * k), first)) if some.any() else a for k in keys]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n.astype(np.int64)), _signed(a), _signed(b),
             pa.array([[int(x[i]) for x in map(lambda c: c.view(np.int64), low)] for i in range(len(n))], pa.list_(pa.int64())),
             parities(g, at)],
            names=["doc_id", "n", "fp", "fp2", "mins", "sig"])


def parities(g: np.ndarray, at: np.ndarray) -> pa.Array:
    """Parity signature of each set, as 64-bit words: two to four bits per
    n-gram, a power of two, FOLD words at least and SIGNATURE at most (longer sets
    are bounded less by it, then by their bitmaps). The signature of half the size is
    the exclusive or of the halves."""
    out = []
    for a, b in zip(at[:-1], at[1:]):
        size = min(max(64 * FOLD, 1 << int(2 * (b - a)).bit_length()), 64 * SIGNATURE)
        odd = np.bincount((g[a:b] & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
    ends = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))


def folds(sig: Column) -> list[Column]:
    """The FOLD words of a signature folded to that size."""
    none = F.lit(0).cast("long")

    def fold(k: int) -> Column:
        mine = F.transform(sig, lambda v, i: F.when(i % FOLD == k, v).otherwise(none))
        return F.aggregate(mine, none, lambda t, v: t.bitwiseXOR(v)).alias(f"f{k}")

    return [fold(k) for k in range(FOLD)]


def differing(x: Column, y: Column) -> Column:
    """Bits in which two parity signatures differ, the longer one folded; of
    sizes that may link, one is at most twice the other."""
    def folded(v: Column, other: Column) -> Column:
        k = F.size(other)
        return F.when(F.size(v) > k, F.zip_with(F.slice(v, F.lit(1), k), F.slice(v, k + 1, k), lambda p, q: p.bitwiseXOR(q))).otherwise(v)

    each = F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(each, F.lit(0), lambda t, v: t + F.coalesce(v, F.lit(0)))


def _count(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.uint32)
    for _, data, off in text_chunks(batches):
        g, _ = gram_sets(data, off, words)
        counts += np.bincount((g >> np.uint64(44)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])


def gram_counts(texts: DataFrame, words: int = WORDS) -> np.ndarray:
    """Number of sets by the n-grams' leading bits: the tasks' tables, of one
    fixed size, are added in a tree on the executors."""
    parts = texts.mapInArrow(lambda b: _count(b, words), "counts binary").rdd.map(lambda r: np.frombuffer(bytes(r["counts"]), np.uint32))
    n = parts.getNumPartitions()
    while n > 1:
        n = -(-n // 16)
        parts = parts.mapPartitionsWithIndex(lambda i, xs, n=n: ((i % n, x) for x in xs)).reduceByKey(lambda a, b: a + b, n).values()
    return reduce(lambda a, b: a + b, parts.collect(), np.zeros(COUNTERS, np.uint32))


def _spread(v: np.ndarray, some: np.ndarray) -> np.ndarray:
    out = np.zeros(len(some), np.uint64)
    out[some] = v
    return out


def describe(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n, fingerprint (fp, fp2), min-hashes and parity signature of every row."""
    return texts.mapInArrow(lambda b: _describe(b, words), "doc_id long, n long, fp long, fp2 long, mins array<long>, sig array<long>")


def chosen(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose doc_id is in ``ids``. A list of ids known to
    be small goes to the executors; otherwise the join is shuffled."""
    few = ids.count() <= BROADCAST_IDS
    return texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _sets(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for rows, data, off in text_chunks(batches):
        g, at = gram_sets(data, off, words)
        raw = g.tobytes()
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([raw[8 * a:8 * b] for a, b in zip(at[:-1], at[1:])], pa.binary())],
                                         names=["doc_id", "grams"])


def tree_overlaps(one: np.ndarray, others: list[np.ndarray], measure: Measure) -> list[bool]:
    """Whether ``one`` links with each of ``others`` (all sorted): a walk over
    the prefix tree of ``others``. The counts along a branch are kept, so a
    beginning that partners share is counted once."""
    order = sorted(range(len(others)), key=lambda i: others[i].tobytes())
    out = [False] * len(others)
    path, counts = np.zeros(0, np.uint64), np.zeros(1, np.int64)  # counts[k]: of the first k in path
    for i in order:
        b = others[i]
        least = measure.overlap(len(one), len(b))
        k = min(len(path), len(b))
        differ = np.flatnonzero(path[:k] != b[:k])
        shared = int(differ[0]) if len(differ) else k
        counts = counts[:shared + 1]
        while True:
            at, have = len(counts) - 1, int(counts[-1])
            rest = len(one) - int(np.searchsorted(one, b[at - 1], "right")) if at else len(one)
            if at == len(b) or have + min(len(b) - at, rest) < least:
                break
            step = b[at:at + 256]
            where = np.searchsorted(one, step)
            hit = one[np.minimum(where, len(one) - 1)] == step
            counts = np.concatenate([counts, have + np.cumsum(hit)])
        path = b[:len(counts) - 1]
        out[i] = len(counts) - 1 == len(b) and int(counts[-1]) >= least
    return out


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Bits (in bytes) of a set: four to eight per n-gram, a power of two."""
    size = 1 << max(6, (4 * len(grams) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(grams & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def may_link(a: bytes, n: int, b: bytes, m: int, measure: Measure) -> bool:
    """False only if the bitmaps show that the sets, of n and m, don't link."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    return (n + m - int(np.bitwise_count(x ^ y).sum())) // 2 >= measure.overlap(n, m)


def _bitmaps(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for rows, data, off in text_chunks(batches):
        g, at = gram_sets(data, off, words)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.diff(at)), pa.array([bitmap(g[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
            names=["doc_id", "n", "bits"])


def _met(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """``pairs`` with the columns of ``side`` for a (x_...) and b (y_...)."""
    for end, mark in (("a", "x_"), ("b", "y_")):
        pairs = pairs.join(side.select(F.col("doc_id").alias(end), *(F.col(c).alias(mark + c) for c in side.columns if c != "doc_id")), end)
    return pairs


def _read(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    return chosen(texts, materialise(ids, "ids"))


def verified(pairs: DataFrame, texts: DataFrame, measure: Measure, words: int = WORDS) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets link."""
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    bits = _read(texts, pairs).mapInArrow(lambda x: _bitmaps(x, words), "doc_id long, n long, bits binary").dropDuplicates(["doc_id"])

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, n, y, m = (batch.column(c) for c in ("a", "b", "x_bits", "x_n", "y_bits", "y_n"))
            keep = [may_link(x[k].as_py(), n[k].as_py(), y[k].as_py(), m[k].as_py(), measure) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    likely = materialise(_met(pairs, materialise(bits, "bitmaps")).mapInArrow(bound, "a long, b long"), "likely_pairs")
    sets = _read(texts, likely).mapInArrow(lambda x: _sets(x, words), "doc_id long, grams binary").dropDuplicates(["doc_id"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a run of rows with the same b is one tree
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("x_grams"), batch.column("y_grams")
            keep, lo = [], 0
            while lo < len(b):
                hi = lo + 1
                while hi < len(b) and b[hi] == b[lo] and hi - lo < 256:
                    hi += 1
                one = np.frombuffer(right[lo].as_py(), np.uint64)
                keep += tree_overlaps(one, [np.frombuffer(left[k].as_py(), np.uint64) for k in range(lo, hi)], measure)
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _met(likely, sets).mapInArrow(run, "a long, b long")


def star_pairs(nodes: DataFrame, measure: Measure) -> DataFrame:
    """(a, b): each node with the least id that shares a min-hash with it,
    where AGREE min-hashes agree (what this leaves out comes up in step 3)."""
    each = nodes.select("id", "n", "mins", F.posexplode("mins").alias("k", "low"))
    centre = each.groupBy("k", "low").agg(F.min(F.struct("id", "n", "mins")).alias("c"), F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    agree = F.aggregate(F.zip_with("mins", "c.mins", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (each.join(centre, ["k", "low"])
            .where((F.col("id") != F.col("c.id")) & measure.sizes(F.col("n"), F.col("c.n")) & (agree >= AGREE))
            .select(F.col("id").alias("a"), F.col("c.id").alias("b")).distinct())


def _prefixes(batches: Iterable[pa.RecordBatch], words: int, measure: Measure, counts: np.ndarray, last: np.ndarray, times: int) -> Iterator[pa.RecordBatch]:
    """The first n-grams of each set, ``times`` as many as its prefix has (size
    p), by ``counts``; n-grams in ``last`` (sorted) come after all others."""
    for rows, data, off in text_chunks(batches):
        g, at = gram_sets(data, off, words)
        n = np.diff(at)
        rank = counts[(g >> np.uint64(44)).astype(np.int64)].astype(np.int64)
        if len(last):
            rank += (last[np.minimum(np.searchsorted(last, g), len(last) - 1)] == g).astype(np.int64) << 32
        g = g[np.lexsort((g, rank, np.repeat(np.arange(len(n)), n)))]
        p = np.minimum(measure.prefix(n), n)
        size, p = p, np.minimum(times * p, n)
        first = np.concatenate([[0], np.cumsum(p)])
        take = np.arange(first[-1]) + np.repeat(at[:-1] - first[:-1], p)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n.astype(np.int32)), pa.array(size.astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _signed(g[take]))],
            names=["doc_id", "n", "p", "grams"])


def prefix_pairs(texts: DataFrame, nodes: DataFrame, parts: DataFrame, measure: Measure, words: int = WORDS, light: int = LIGHT) -> Iterator[DataFrame]:
    """Candidate (a, b) in different components, a table per step (see 3.).
    ``nodes``: id, sig (the documents to join); ``parts``: id, component."""
    spark = texts.sparkSession
    counts = spark.sparkContext.broadcast(gram_counts(chosen(texts, nodes.select(F.col("id").alias("doc_id"))), words))
    last, demoted, times = np.zeros(0, np.uint64), None, 1
    todo = nodes.select(F.col("id").alias("doc_id"))
    while True:
        order = last
        lists = chosen(texts, todo).mapInArrow(lambda b, o=order, k=times: _prefixes(b, words, measure, counts.value, o, k), "doc_id long, n int, p int, grams array<long>")
        posted = lists.select("doc_id", "n", "p", F.posexplode("grams").alias("at", "gram"))
        several = posted.groupBy("gram").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x != y").select("gram")
        kept = (posted.join(several, "gram")
                .join(parts.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
                .withColumn("component", F.coalesce("component", "doc_id")))
        kept = materialise(kept, "postings")
        spread = (kept.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size"))
                  .where("x != y").select("gram", "size"))
        spread = materialise(spread, "grams")
        heavy = spread.where(F.col("size") > light).select("gram")
        new = materialise(heavy if demoted is None else heavy.join(demoted, "gram", "left_anti"), "frequent")
        found = np.array([r["gram"] for r in new.limit(BROADCAST_GRAMS + 1).collect()], np.int64).view(np.uint64)
        # N-grams that were put last before are paired now (their sets have
        # nothing rarer left), and so are all if there are too many to hold.
        full = len(found) + len(last) > BROADCAST_GRAMS
        use = spread.select("gram") if full else spread.select("gram").join(new, "gram", "left_anti")
        lists = kept.where(F.col("at") < F.col("p")).join(use, "gram")
        lists = lists.join(nodes.select(F.col("id").alias("doc_id"), "sig", *folds(F.col("sig"))), "doc_id")
        words_of = [f"f{k}" for k in range(FOLD)]
        left = lists.select("gram", *(F.col(c).alias(c + "1") for c in ("doc_id", "n", "at", "component", "sig", *words_of)))
        right = lists.select("gram", *(F.col(c).alias(c + "2") for c in ("doc_id", "n", "at", "component", "sig", *words_of)))
        n1, n2, i, j = F.col("n1"), F.col("n2"), F.col("at1"), F.col("at2")
        bound = F.least(n1 - i, n2 - j) + F.least(i, j)
        coarse = reduce(lambda x, y: x + y, [F.bit_count(F.col(f + "1").bitwiseXOR(F.col(f + "2"))) for f in words_of])
        yield (left.join(right, "gram")
               .where((F.col("doc_id1") < F.col("doc_id2")) & (F.col("component1") != F.col("component2"))
                      & measure.sizes(n1, n2) & ((100 + measure.percent) * bound >= measure.percent * (n1 + n2))
                      & ((100 + measure.percent) * (n1 + n2 - coarse) >= 2 * measure.percent * (n1 + n2))
                      & ((100 + measure.percent) * (n1 + n2 - differing(F.col("sig1"), F.col("sig2"))) >= 2 * measure.percent * (n1 + n2)))
               .select(F.col("doc_id1").alias("a"), F.col("doc_id2").alias("b")))
        if full or not len(found):
            return
        last = np.unique(np.concatenate([last, found]))
        demoted = new if demoted is None else demoted.unionByName(new)
        # Only sets with such n-grams in the prefix itself go on; of those, eight
        # times as many n-grams are counted, so that few steps find them all.
        todo = materialise(kept.where(F.col("at") < F.col("p")).join(new, "gram", "left_semi").select("doc_id").distinct(), "again")
        times *= 8  # a prefix is an eighth of a set or more at 85 %, so this is the whole set


def join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    measure = Measure(percent)
    texts = id_text(docs)
    info = materialise(describe(texts, words), "sets_described")
    same = info.where("n > 0").groupBy("fp", "fp2", "n").agg(F.min("doc_id").alias("id"), F.first("mins").alias("mins"), F.first("sig").alias("sig"))
    nodes = materialise(same, "nodes")
    links = materialise(verified(star_pairs(nodes, measure), texts, measure, words), "star_links")
    steps = [materialise(pairs, "prefix_pairs") for pairs in prefix_pairs(texts, nodes, components(links), measure, words)]
    more = verified(reduce(DataFrame.unionByName, steps), texts, measure, words)
    parts = components(links.unionByName(more))
    named = nodes.select("fp", "fp2", F.col("n").alias("n_"), "id").join(parts, "id", "left").select(
        "fp", "fp2", "n_", F.coalesce("component", "id").alias("component"))
    out = info.join(named, (info["fp"] == named["fp"]) & (info["fp2"] == named["fp2"]) & (info["n"] == named["n_"]), "left")
    return out.select("doc_id", info["n"].alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
