"""Quality classifier: a generalised additive model with pairwise interactions
(operator 8).

Cyclic boosting: in turn, each feature gets a shallow tree fitted to the
gradient of the logistic loss, added with a small rate to the feature's lookup
table over its bins; then the strongest pairs of features get trees over pairs
of bins in the same way. A document's score is the sigmoid of an intercept and
one table entry per feature and pair: vectorised bin additions.

Features come from the whole text alone. The model is fitted on at most
``MAX_LABELS`` labelled rows (those of least hash of the id, so the same rows
whatever the partitioning), in the driver: at most MAX_LABELS x 18 numbers.
Everything is scored on the executors.

Contract cases: NULL and empty texts have all-zero features and get a score
like any other; without labels (or with one class only) every score is the
share of label 1 (0.5 without labels); of several labels of a document the
lowest counts; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import (id_text, line_spans, per_text_sum, shingle_hashes, span_hashes,
                                 text_chunks, word_spans)

MAX_LABELS = 20_000
THRESHOLD = 0.7
ROUNDS, PAIR_ROUNDS, RATE, BINS, PAIRS = 120, 40, 0.15, 32, 8

FEATURES = ("log_words", "log_bytes", "word_bytes", "short_words", "long_words", "symbols", "pipes",
            "bangs", "upper", "digits", "non_ascii", "same_as_previous", "distinct_words",
            "repeated_trigrams", "duplicate_lines", "words_per_line", "symbol_words", "upper_words")


def _classes(*chars: str) -> np.ndarray:
    t = np.zeros(256, np.int8)
    for c in chars:
        t[list(c.encode())] = 1
    return t


_SYMBOL, _PIPE, _BANG = _classes("#*$%&|<>"), _classes("|"), _classes("!?")
_UPPER, _LOWER = _classes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _classes("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _classes("0123456789")


def distinct_per_text(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    n = len(bounds) - 1
    own = np.repeat(np.arange(n, dtype=np.uint64), np.diff(bounds))
    key = np.sort((own << np.uint64(44)) | (hashes >> np.uint64(20)))
    if not len(key):
        return np.zeros(n, np.int64)
    first = np.concatenate([[True], key[1:] != key[:-1]])
    return np.bincount((key[first] >> np.uint64(44)).astype(np.int64), minlength=n)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    starts, ends, bounds = word_spans(data, offsets)
    words = np.diff(bounds)
    h = span_hashes(data, starts, ends)
    length = ends - starts
    tri, tri_bounds = shingle_hashes(h, bounds, 3)
    ls, le, line_bounds = line_spans(data, offsets)
    inked = le > ls
    kept = np.concatenate([[0], np.cumsum(inked)])[line_bounds]
    line_hashes = span_hashes(data, ls[inked], le[inked])
    lines = np.diff(kept)
    same = np.zeros(len(h), np.int8)
    same[1:] = h[1:] == h[:-1]
    same[bounds[:-1][words > 0]] = 0
    of = lambda t: per_text_sum(t[data], offsets)
    total = lambda t: np.concatenate([[0], np.cumsum(t[data], dtype=np.int64)])
    per = lambda a, b: a / np.maximum(b, 1)
    symbols, upper, lower = total(_SYMBOL), total(_UPPER), total(_LOWER)
    in_word = lambda t: t[ends] - t[starts]
    sym_word = in_word(symbols) > 0
    up_word = (in_word(upper) > 1) & (in_word(lower) == 0)
    out = np.stack([
        np.log1p(words), np.log1p(size), per(per_text_sum(length, bounds), words),
        per(per_text_sum(length <= 3, bounds), words), per(per_text_sum(length >= 15, bounds), words),
        per(symbols[offsets[1:]] - symbols[offsets[:-1]], size), per(of(_PIPE), size), per(of(_BANG), size),
        per(upper[offsets[1:]] - upper[offsets[:-1]], of(_UPPER) + of(_LOWER)), per(of(_DIGIT), size),
        per(per_text_sum(data >= 128, offsets), size), per(per_text_sum(same, bounds), words),
        per(distinct_per_text(h, bounds), words), 1 - per(distinct_per_text(tri, tri_bounds), np.diff(tri_bounds)),
        1 - per(distinct_per_text(line_hashes, kept), lines), per(words, lines),
        per(per_text_sum(sym_word, bounds), words), per(per_text_sum(up_word, bounds), words),
    ], axis=1)
    out[words == 0] = 0
    return out.reshape(n, len(FEATURES))


# ---------------------------------------------------------------- the model
def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _split_gain(g: np.ndarray, h: np.ndarray, lam: float = 1.0) -> tuple[float, int]:
    """Best cut of a run of bins: (gain, bins left of it)."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    if len(g) < 2:
        return 0.0, 0
    left = cg[:-1] ** 2 / (ch[:-1] + lam)
    right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + lam)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + lam)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3, lam: float = 1.0) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over ordered bins, as a step per bin."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        best = max(((*_split_gain(g[a:b], h[a:b], lam), a, b) for a, b in runs), key=lambda r: r[0])
        if best[0] <= 1e-9:
            break
        _, k, a, b = best
        runs.remove((a, b))
        runs += [(a, a + k), (a + k, b)]
    step = np.zeros(len(g))
    for a, b in runs:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + lam)
    return step


def pair_tree(g: np.ndarray, h: np.ndarray, lam: float = 1.0) -> tuple[np.ndarray, float]:
    """A depth-two tree over pairs of bins: one axis is cut, then each side
    along the other. Returns the step per pair and its gain."""
    best, out = -1.0, np.zeros_like(g)
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        _, k = _split_gain(a.sum(1), b.sum(1), lam)
        for cut in {k, len(a) // 2} - {0, len(a)}:
            step, gain = np.zeros_like(a), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                s = shallow_tree(a[rows].sum(0), b[rows].sum(0), 2, lam)
                step[rows] = s
                gain += float((s * a[rows].sum(0)).sum())
            if gain > best:
                best, out = gain, step.T if turn else step
    return out, best


class AdditiveModel:
    """Lookup tables over feature bins and over pairs of coarser bins."""

    def __init__(self, bias: float, n_features: int):
        self.bias = bias
        self.edges = [np.zeros(0)] * n_features
        self.tables = [np.zeros(1)] * n_features
        self.pairs: list[tuple[int, int]] = []
        self.pair_edges = [np.zeros(0)] * n_features
        self.pair_tables: list[np.ndarray] = []

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> "AdditiveModel":
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        m = cls(float(np.log(share / (1 - share))), len(FEATURES))
        if not len(y) or y.min() == y.max():
            m.bias = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
            return m
        d = x.shape[1]
        m.edges = [_edges(x[:, j], BINS) for j in range(d)]
        m.tables = [np.zeros(len(e) + 1) for e in m.edges]
        at = [np.searchsorted(m.edges[j], x[:, j], "left") for j in range(d)]
        z = np.full(len(y), m.bias)
        for _ in range(ROUNDS):
            for j in range(d):
                p = 1 / (1 + np.exp(-z))
                size = len(m.tables[j])
                g, h = np.bincount(at[j], y - p, size), np.bincount(at[j], p * (1 - p), size)
                step = RATE * shallow_tree(g, h)
                m.tables[j] += step
                z += step[at[j]]
        m.pair_edges = [_edges(x[:, j], 8) for j in range(d)]
        coarse = [np.searchsorted(m.pair_edges[j], x[:, j], "left") for j in range(d)]
        p = 1 / (1 + np.exp(-z))

        def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
            na, nb = len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1
            return np.bincount(coarse[a] * nb + coarse[b], v, na * nb).reshape(na, nb)

        gains = {(a, b): pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[1] for a, b in combinations(range(d), 2)}
        m.pairs = sorted(gains, key=lambda k: -gains[k])[:PAIRS]
        m.pair_tables = [np.zeros((len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1)) for a, b in m.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (a, b) in enumerate(m.pairs):
                p = 1 / (1 + np.exp(-z))
                step = RATE * pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[0]
                m.pair_tables[k] += step
                z += step[coarse[a], coarse[b]]
        return m

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[j], x[:, j], "left")]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            z += t[np.searchsorted(self.pair_edges[a], x[:, a], "left"), np.searchsorted(self.pair_edges[b], x[:, b], "left")]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in text_chunks(batches):
        x = text_features(data, off)
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                                         names=["doc_id", "features"])


def features(docs: DataFrame) -> DataFrame:
    return id_text(docs).mapInArrow(_featurise, "doc_id long, features array<double>")


def _bucket() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> AdditiveModel:
    """Fit on at most ``max_labels`` labelled documents outside the held-out fold."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (_bucket() != 2))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    rows = features(docs.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi"))
    got = rows.join(F.broadcast(sample), "doc_id").orderBy("doc_id").limit(2 * max_labels).collect()
    x = np.array([r["features"] for r in got], float).reshape(len(got), len(FEATURES))
    return AdditiveModel.fit(x, np.array([r["quality"] for r in got], float))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(text_features(data, off)))], names=["doc_id", "score"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (_bucket() == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep_good(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in text_chunks(batches):
            yield rows.filter(pa.array(shared.value.score(text_features(data, off)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
