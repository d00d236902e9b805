"""Benchmark decontamination by latent semantic retrieval (operator 7).

1. The vocabulary is the benchmark's: words that no item has can't help to find
   one. Every document is cut into passages of BLOCK * 2 words. One pass over all
   documents counts passage frequencies of those words and adds each passage,
   with a random sign, to one of ROWS rows: a randomised row sketch of the
   passage-by-word matrix. It is linear, so idf weights are applied after the
   sum over tasks (a fixed ROWS x COLUMNS matrix, summed in a tree).
2. The sketch, stacked with the benchmark's own rows, is decomposed (SVD); its
   RANK leading right singular vectors are the latent space.
3. Words in more than COMMON of all passages weigh nothing, unless an item would
   have weights for fewer than half of its words: its rarest half then keep one (copies
   of a leak make all words of its item frequent).
4. A second pass projects half-overlapping passages of every document (sums of
   latent word vectors) and compares those that hold a word of weight with all
   benchmark items, a block of items at a time; items of more than two
   passages are compared by passages of their own. Candidates are passages with a
   cosine of COSINE or more (less for items that are shorter than a passage), and
   enough words for SHARE of the item's vector.
5. A candidate is a leak if the longest common subsequence of the item and the
   best nearby stretch of the document holds LCS_SURE of the item's words, or
   LCS_LIKELY of them and most of the item's answer (its last words).

The candidate search is approximate (tests measure its recall against brute
force); the check is exact. No shuffle of text: what is sent is the sketch and
the leaks. Items go to the executors in blocks of bounded size.

Words are runs of letters and digits without regard to ASCII case.

Contract cases: NULL and empty texts and items without words match nothing; an
empty benchmark or table gives an empty result; repeated documents or items are
reported each; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import (LETTER_GAPS, LOWER_VALUES, id_text, mix, span_hashes, string_buffers,
                                 text_chunks, word_spans)

BLOCK = 16                # words; a passage is two blocks
COLUMNS, ROWS, RANK = 8192, 128, 64
WIDE = 1 << 18            # columns of words' weights; their low bits are the column of the sketch
COMMON = 0.05             # words in more than this share of passages weigh nothing, unless an item needs them
LEAST_IDF = 0.1           # of a word that an item needs
COSINE, SHARE = 0.6, 0.25
LCS_SURE, LCS_LIKELY, ANSWER_SHARE, ANSWER_FOUND = 0.75, 0.6, 0.25, 0.6
ITEMS_AT_ONCE = 20_000
FAN_IN = 4                # sketches (of 6 MB) that a task adds up
LEAKS = "doc_id long, item_id long, cosine double, lcs double, answer double, start_word long, end_word long"


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = word_spans(data, offsets, LETTER_GAPS)
    return span_hashes(data, starts, ends, LOWER_VALUES), bounds


def blocks(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word index) of the blocks of each text, and the text of each."""
    n = -(-np.diff(bounds) // size)
    own = np.repeat(np.arange(len(n)), n)
    first = np.concatenate([[0], np.cumsum(n)])
    return bounds[own] + (np.arange(first[-1]) - first[own]) * size, own


# ------------------------------------------------------------------ sketch
def wide(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(WIDE - 1)).astype(np.int64)


def _sketch(batches: Iterable[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    rows = np.zeros(ROWS * COLUMNS, np.float32)
    df = np.zeros(WIDE + 1, np.int64)  # and the number of passages
    for _, data, off in text_chunks(batches):
        h, bounds = text_words(data, off)
        at, _ = blocks(bounds, 2 * BLOCK)
        if not len(at):
            continue
        passage = np.zeros(len(h), np.int64)
        passage[at[1:]] = 1
        passage = np.cumsum(passage)
        col = wide(h)
        if wanted is not None:
            some = wanted[col]
            passage, col = passage[some], col[some]
        df[WIDE] += len(at)
        if not len(col):
            continue
        key = np.sort(passage * WIDE + col)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        col, own = key % WIDE, key // WIDE
        salt = mix(h[at] + np.arange(len(at), dtype=np.uint64))
        row = (salt >> np.uint64(8)) % np.uint64(ROWS)
        sign = np.where(salt & np.uint64(1), 1, -1).astype(np.float32)
        np.add.at(rows, row[own].astype(np.int64) * COLUMNS + col % COLUMNS, sign[own])
        df[:WIDE] += np.bincount(col, minlength=WIDE)
    yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary()), pa.array([df.tobytes()], pa.binary())], names=["rows", "df"])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of sketches, one at a time."""
    rows, df = np.zeros(ROWS * COLUMNS, np.float32), np.zeros(WIDE + 1, np.int64)
    for batch in batches:
        for r, d in zip(batch.column("rows"), batch.column("df")):
            rows += np.frombuffer(r.as_buffer(), np.float32)
            df += np.frombuffer(d.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary()), pa.array([df.tobytes()], pa.binary())], names=["rows", "df"])


def sketch(texts: DataFrame, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(sketch ROWS x COLUMNS, passage frequency of each of the WIDE columns,
    passages), of the words whose column is ``wanted`` (None: of all).

    The tasks' sketches, of one fixed size, are added in a tree on the
    executors, each step in tasks of its own with one Python worker; the driver gets the one sum."""
    schema = "rows binary, df binary"
    n = texts.rdd.getNumPartitions()
    parts = texts.mapInArrow(lambda b: _sketch(b, wanted), schema)
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(_added, schema)
    got = parts.collect()
    if not got:
        return np.zeros((ROWS, COLUMNS), np.float32), np.zeros(WIDE, np.int64), 0
    rows, df = (np.frombuffer(bytes(got[0][c]), t) for c, t in (("rows", np.float32), ("df", np.int64)))
    return rows.reshape(ROWS, COLUMNS), df[:WIDE], int(df[WIDE])


def idf(df: np.ndarray, passages: int) -> np.ndarray:
    return np.log((passages + 1) / (df + 1)).astype(np.float32)


def latent_space(corpus: np.ndarray, items: np.ndarray, df: np.ndarray, passages: int, rank: int = RANK) -> np.ndarray:
    """Latent vector of each column: the leading right singular vectors of the
    idf-weighted sketch over the benchmark's rows, both sides of equal weight."""
    weight = np.maximum(idf(df.reshape(-1, COLUMNS).sum(axis=0), passages), LEAST_IDF)
    sides = [x * weight for x in (corpus, items)]
    stack = np.vstack([x / (np.linalg.norm(x) or 1) for x in sides])
    w, u = np.linalg.eigh((stack @ stack.T).astype(np.float64))
    top = np.argsort(-w)[:rank]
    top = top[w[top] > 1e-9]
    return stack.T @ (u[:, top] / np.sqrt(w[top])).astype(np.float32)


def _needed(batches: Iterable[pa.RecordBatch], df: np.ndarray, most: float) -> Iterator[pa.RecordBatch]:
    """Columns of the common words that items can't do without."""
    found: list[np.ndarray] = []
    for _, data, off in text_chunks(batches):
        h, bounds = text_words(data, off)
        col = wide(h)
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = col[a:b]
            half = -(-(b - a) // 2)
            if np.count_nonzero(df[own] <= most) < half:
                rarest = own[np.argsort(df[own], kind="stable")[:half]]
                found.append(rarest[df[rarest] > most])
    got = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64())], names=["col"])


def word_weights(queries: DataFrame, df: np.ndarray, passages: int, wanted: np.ndarray) -> np.ndarray:
    """Weight of each of the WIDE columns (see 3.)."""
    most = COMMON * passages + 1
    keep = queries.mapInArrow(lambda b: _needed(b, df, most), "col long").distinct().collect()  # at most WIDE
    out = np.where(wanted & (df <= most), idf(df, passages), 0).astype(np.float32)
    at = np.array([r["col"] for r in keep], np.int64)
    out[at] = idf(df[at], passages)
    return np.where((out > 0) | np.isin(np.arange(WIDE), at), np.maximum(out, LEAST_IDF), 0).astype(np.float32)


# ------------------------------------------------------------------- check
def lcs_length(pattern: dict[int, int], n: int, words: list[int]) -> int:
    """Longest common subsequence with the pattern (bit sets by word), bit-parallel."""
    full = (1 << n) - 1
    row = full
    for w in words:
        m = pattern.get(w)
        if m:
            x = row & m
            row = ((row + x) | (row - x)) & full
    return n - row.bit_count()


def masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


@dataclass
class Item:
    id: int
    n: int
    mask: dict[int, int]
    answer_n: int
    answer: dict[int, int]

    @classmethod
    def of(cls, item_id: int, words: np.ndarray) -> "Item":
        w = words.tolist()
        tail = w[-max(1, round(ANSWER_SHARE * len(w))):]
        return cls(item_id, len(w), masks(w), len(tail), masks(tail))

    def check(self, words: list[int], lo: int, hi: int) -> tuple[float, float, int, int]:
        """(share of the item, share of its answer, start, end) of the best
        stretch, of the item's length and a quarter more, that meets [lo, hi)."""
        near = words[max(0, lo - self.n):hi + self.n]
        common = Counter(filter(self.mask.__contains__, near))
        if sum(min(c, self.mask[w].bit_count()) for w, c in common.items()) < LCS_LIKELY * self.n:
            return 0.0, 0.0, lo, lo  # no subsequence can be long enough
        size = self.n + max(2, self.n // 4)
        step = max(1, self.n // 4)
        best = (0.0, 0.0, lo, lo)
        for a in range(max(0, lo - self.n), max(lo - self.n, min(hi, len(words) - 1)) + 1, step):
            part = words[a:a + size]
            share = lcs_length(self.mask, self.n, part) / self.n
            if share > best[0]:
                best = (share, lcs_length(self.answer, self.answer_n, part) / self.answer_n, a, a + len(part))
        return best


def is_leak(share: float, answer: float) -> bool:
    return share >= LCS_SURE or (share >= LCS_LIKELY and answer >= ANSWER_FOUND)


def _project(h: np.ndarray, at: np.ndarray, space: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the latent vectors of the words of each block, and whether any has a weight."""
    col = wide(h)
    has = np.flatnonzero(weight[col])
    block = np.searchsorted(at, has, "right") - 1
    col = col[has]
    out, some = np.zeros((len(at), space.shape[1]), np.float32), np.zeros(len(at), bool)
    some[block] = True
    for lo in range(0, len(col), 8192):
        b, c = block[lo:lo + 8192], col[lo:lo + 8192]
        first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
        out[b[first]] += np.add.reduceat(space[c % COLUMNS] * weight[c][:, None], first, axis=0)
    return out, some


@dataclass
class Probes:
    """What passages are compared with: one vector an item, or one for each passage of a long item."""

    latent: np.ndarray     # unit vectors, a column each
    item: np.ndarray       # index into items
    cosine: np.ndarray     # least cosine
    dot: np.ndarray        # least product with the unit vector
    items: list[Item]

    @classmethod
    def of(cls, ids: list[int], h: np.ndarray, bounds: np.ndarray, space: np.ndarray, weight: np.ndarray) -> "Probes":
        vectors, item, words, items = [], [], [], []
        for i in np.flatnonzero(np.diff(bounds)):
            w = h[bounds[i]:bounds[i + 1]]
            parts = [w] if len(w) <= 4 * BLOCK else [w[k:k + 2 * BLOCK] for k in range(0, len(w) - BLOCK, BLOCK)]
            for part in parts:
                c = wide(part)
                vectors.append((space[c % COLUMNS] * weight[c][:, None]).sum(axis=0))
                item.append(len(items))
                words.append(len(part))
            items.append(Item.of(ids[i], w))
        v = np.array(vectors, np.float32).reshape(len(vectors), space.shape[1])
        norm, n = np.linalg.norm(v, axis=1), np.array(words, np.float32)
        fill = np.minimum(1, n / (2 * BLOCK))  # of a passage, by the probe
        held = np.minimum(1, 2 * BLOCK / np.maximum(n, 1))  # of the probe, in a passage
        return cls((v / np.maximum(norm, 1e-9)[:, None]).T.copy(), np.array(item, np.int64),
                   (COSINE * np.sqrt(fill)).astype(np.float32), (SHARE * held * norm).astype(np.float32), items)


def _search(batches: Iterable[pa.RecordBatch], space: np.ndarray, weight: np.ndarray, probes: Probes) -> Iterator[pa.RecordBatch]:
    for rows, data, off in text_chunks(batches):
        h, bounds = text_words(data, off)
        out: list[tuple] = []
        at, own = blocks(bounds, BLOCK)
        if len(at) and probes.latent.shape[1]:
            passage, some = _project(h, at, space, weight)
            joined = np.flatnonzero(own[1:] == own[:-1])  # a passage is a block and the next of its text
            after, more = passage[joined + 1], some[joined + 1]
            passage[joined] += after
            some[joined] |= more
            filled = np.flatnonzero(some)
            norm = np.maximum(np.linalg.norm(passage, axis=1), 1e-9)
            ids = rows.column(0).to_pylist()
            near: dict[tuple[int, int], list[tuple[int, float]]] = {}
            for lo in range(0, len(filled), 4096):
                part = filled[lo:lo + 4096]
                dot = passage[part] @ probes.latent
                hit, k = np.nonzero(dot >= np.maximum(probes.dot, norm[part][:, None] * probes.cosine))
                for p, i, c in zip(part[hit].tolist(), probes.item[k].tolist(), dot[hit, k].tolist()):
                    near.setdefault((int(own[p]), i), []).append((int(at[p]), c / float(norm[p])))
            words: dict[int, list[int]] = {}
            for (doc, i), hits in near.items():
                if doc not in words:
                    words[doc] = h[bounds[doc]:bounds[doc + 1]].tolist()
                item, base = probes.items[i], int(bounds[doc])
                best, cosine = (0.0, 0.0, 0, 0), max(c for _, c in hits)
                for a in dict.fromkeys(a for a, _ in hits):
                    got = item.check(words[doc], a - base, a - base + 2 * BLOCK)
                    best = max(best, got, key=lambda g: (g[0], g[1]))
                if is_leak(best[0], best[1]):
                    out.append((ids[doc], item.id, cosine, *best))
        cols = list(zip(*out)) or [()] * 7
        types = [pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[c.split()[0] for c in LEAKS.split(", ")])


def item_blocks(benchmark: DataFrame, size: int = ITEMS_AT_ONCE) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(ids, word hashes, bounds) of at most ``size`` items at a time."""
    def block(ids: list[int], texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        data, off = string_buffers(pa.array(texts, pa.string()))
        return ids, *text_words(data, off)

    ids: list[int] = []
    texts: list[str] = []
    for r in benchmark.where(F.col("doc_id").isNotNull()).toLocalIterator():
        ids.append(r["doc_id"])
        texts.append(r["text"])
        if len(ids) == size:
            yield block(ids, texts)
            ids, texts = [], []
    if ids:
        yield block(ids, texts)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """LEAKS: every (document, item) whose passages match."""
    spark = docs.sparkSession
    texts, queries = id_text(docs), id_text(benchmark, "item_id")
    asked, item_df, item_passages = sketch(queries)
    wanted = item_df > 0
    corpus, df, passages = sketch(texts, wanted)
    df, passages = df + item_df, passages + item_passages
    space = latent_space(corpus, asked, df, passages)
    weight = word_weights(queries, df, passages, wanted)
    out = None
    for ids, h, bounds in item_blocks(queries):
        shared = spark.sparkContext.broadcast((space, weight, Probes.of(ids, h, bounds, space, weight)))
        found = texts.mapInArrow(lambda b, s=shared: _search(b, *s.value), LEAKS)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], LEAKS) if out is None else out
