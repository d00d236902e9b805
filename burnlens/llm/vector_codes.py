"""Vector code compression (operator 11): product codes with norm-of-sum bounds.

A vector's components become integers ``floor(256 * x)``; the vector is cut into
``PARTS`` equal consecutive parts, and each part is coded by the nearest of at
most ``ENTRIES`` entries of the codebook of its position (squared Euclidean
distance, ties to the lower index). Codebooks start as the parts of the least
vector ids; each round assigns all parts, then moves every used entry to the
floored mean of its parts.

Method. Each part keeps a lower bound of its distance to every group of
``GROUP`` consecutive entries (without its own entry), and the round stamp at
which that bound was exact. All codebooks so far are kept. At round t a bound
of stamp T is lowered by the largest *net* displacement ``|C_t(j) - C_T(j)|`` of
the group's entries, one norm of the summed moves, which is at most the sum of
the norms of the moves. A group whose bound still exceeds the distance to
the part's own entry can't hold the nearest one, nor a tie; every other group is
scanned exactly and gets a new bound with stamp t. Bounds are rounded down to
1/32, displacements and own distances up, so no rounding can hide an entry.

Spark: vectors and their bounds are a table in the shared folder, read and
written once a round (lineage is cut there); tasks sum the parts of each entry,
and 16 * 64 sums are added by a grouped aggregate. Only codebooks (64 vectors) and
those sums pass through the driver, whatever the number of vectors. Labels are
summed before the shuffle and joined back, where Spark splits a hot label.

Arithmetic is exact: float32 or float64 products where all sums are integers
that these types hold (checked for every batch), else Python integers.

Contract cases: rows whose vector is NULL or empty, holds a NULL, NaN or infinite
component, or has another length than the least vec_id's kept vector, are
dropped. A length that 16 doesn't divide is filled up with zeros. Repeated
vec_ids are coded each; a codebook starts from distinct vec_ids, with the least
vector of each; a NULL vec_id comes after all others. With fewer than 64 of them
the codebook is shorter. Sums beyond a long are the largest long. Very long
vectors only make batches of fewer rows; there is no text. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import materialise

PARTS, ENTRIES, ROUNDS = 16, 64, 2
GROUP = 16     # consecutive entries that share a bound
SCALE = 32     # bounds are multiples of 1 / SCALE
CHUNK = 4096   # vectors coded at once
TOP_BOUND = 65535
LIMB = 40      # bits of a partial sum in one row
MAX_LONG = 2**63 - 1


# ------------------------------------------------------------ exact arithmetic
def quantise(x: np.ndarray) -> np.ndarray:
    """floor(256 * x); exact in float64, as 256 is a power of two."""
    return np.floor(256.0 * x)


def _big(a: np.ndarray) -> np.ndarray:
    """The same integers as Python numbers."""
    return np.array([int(v) for v in a.ravel()], object).reshape(a.shape)


def _kind(top: float, width: int) -> type:
    """The cheapest type in which a squared distance of such parts is exact."""
    bound = 4 * width * int(top) ** 2
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays (rows of the same width) in a type that keeps squared
    distances between their rows exact."""
    top = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
    kind = _kind(top, arrays[0].shape[-1])
    return [_big(a) if kind is object else a.astype(kind) for a in arrays]


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances (rows of x, rows of c) of ``exact`` arrays."""
    if x.dtype == object:
        return sum((x[:, None, k] - c[None, :, k]) ** 2 for k in range(x.shape[1]))
    return (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)


def own_squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of x to the same row of c, of ``exact`` arrays."""
    return ((x - c) ** 2).sum(1)


def _root(d2: np.ndarray) -> np.ndarray:
    return SCALE * np.sqrt(d2.astype(np.float64))


# ------------------------------------------------------------ codebooks
@dataclass(frozen=True)
class Codebook:
    """entries[part][index] is a tuple of integers; ``dim`` the vectors' length."""
    entries: tuple[tuple[tuple[int, ...], ...], ...]
    dim: int

    @property
    def size(self) -> int:
        return len(self.entries[0]) if self.entries else 0

    def array(self) -> np.ndarray:
        """(parts, entries, width) for decoding; integers over 2**53 are rounded."""
        return np.array(self.entries, np.float64)

    def part(self, p: int) -> np.ndarray:
        """(entries, width), exact."""
        small = all(abs(v) < 1 << 53 for e in self.entries[p] for v in e)
        return np.array(self.entries[p], np.float64 if small else object)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for p in self.entries for e in p for v in e).encode()).hexdigest()


def net_displacement(old: Codebook, new: Codebook) -> np.ndarray:
    """(parts, groups): the largest displacement of a group's entries between
    the two codebooks, in 1 / SCALE, rounded up."""
    out = []
    for p in range(len(new.entries)):
        moved = np.ceil(_root(own_squares(*exact(new.part(p), old.part(p)))))
        out.append([moved[g:g + GROUP].max() for g in range(0, new.size, GROUP)])
    return np.array(out)


# ------------------------------------------------------------ one round over a batch
def assign(x: np.ndarray, codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray,
           history: list[Codebook], drift: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Code the vectors ``x`` (rows, parts, width) by the last of ``history``.
    ``codes``, ``bounds`` and ``stamps`` are brought up to date in place.
    Returns each vector's squared error and how many groups were scanned."""
    now, book = len(history) - 1, history[-1]
    n, k, groups = len(x), book.size, bounds.shape[2]
    error, scanned = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows = np.arange(n)
    for p in range(PARTS):
        part, entries = exact(x[:, p], book.part(p))
        own = codes[:, p].astype(np.int64)
        if now:
            bound = bounds[:, p].astype(np.float64)
            for t in range(now):
                at = stamps[:, p] == t
                bound -= np.where(at, drift[t][p][None, :], 0.0)
            own2 = own_squares(part, entries[own])
            scan = bound <= np.ceil(_root(own2))[:, None]
        else:
            bound, own2, scan = np.zeros((n, groups)), own_squares(part, entries[own]), np.ones((n, groups), bool)
        best, best2 = own.copy(), own2.copy()
        seen = []
        for g in range(groups):
            hit = np.flatnonzero(scan[:, g])
            lo, hi = g * GROUP, min(k, (g + 1) * GROUP)
            d2 = squares(part[hit], entries[lo:hi]) if len(hit) else np.zeros((0, hi - lo))
            seen.append((hit, d2))
            if len(hit):
                at = d2.argmin(1)
                least = d2[np.arange(len(hit)), at]
                better = (least < best2[hit]) | ((least == best2[hit]) & (at + lo < best[hit]))
                best[hit[better]], best2[hit[better]] = at[better] + lo, least[better]
        for g, (hit, d2) in enumerate(seen):
            if not len(hit):
                continue
            mine = best[hit] - g * GROUP
            inside = np.flatnonzero((mine >= 0) & (mine < d2.shape[1]))
            far = _root(np.minimum(d2, 2**40))
            far[inside, mine[inside]] = np.inf
            bounds[hit, p, g] = np.minimum(np.floor(far.min(1)), TOP_BOUND)
            stamps[hit, p, g] = now
        # an entry left behind in a group that wasn't scanned joins that group's bound
        left = rows[(best != own) & ~scan[rows, own // GROUP]]
        if len(left):
            g = own[left] // GROUP
            bounds[left, p, g] = np.clip(np.minimum(bound[left, g], np.floor(_root(own2[left]))), 0, TOP_BOUND)
            stamps[left, p, g] = now
        codes[:, p] = best
        error = error + (best2 if best2.dtype == object else best2.astype(np.int64))
        scanned += scan.sum(1)
    return error, scanned


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """(rows, parts, width) of a list column whose lists all have ``dim`` items."""
    flat = np.asarray(col.flatten(), np.float64).reshape(-1, dim)
    width = -(-dim // PARTS)
    if width * PARTS != dim:
        flat = np.concatenate([flat, np.zeros((len(flat), width * PARTS - dim))], 1)
    return flat.reshape(-1, PARTS, width)


def _bytes(col: pa.Array, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, *shape).copy()


def _binary(a: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in a], pa.binary())


def _round(batches: Iterable[pa.RecordBatch], history: list[Codebook], drift: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
    book = history[-1]
    groups = -(-book.size // GROUP)
    for whole in batches:
        for lo in range(0, whole.num_rows, CHUNK):
            batch = whole.slice(lo, CHUNK)
            n = batch.num_rows
            first = len(history) == 1
            x = _matrix(batch.column("vector"), book.dim)
            if first:
                x = quantise(x)
                codes, bounds = np.zeros((n, PARTS), np.uint8), np.zeros((n, PARTS, groups), np.uint16)
                stamps = np.zeros((n, PARTS, groups), np.uint8)
            else:
                codes = _bytes(batch.column("codes"), np.uint8, (PARTS,))
                bounds = _bytes(batch.column("bounds"), np.uint16, (PARTS, groups))
                stamps = _bytes(batch.column("stamps"), np.uint8, (PARTS, groups))
            error, scanned = assign(x, codes, bounds, stamps, history, drift)
            error = pa.array([min(int(e), MAX_LONG) for e in error], pa.int64())
            head = [batch.column("vec_id"), batch.column("label"), _binary(codes), error, pa.array(scanned, pa.int32())]
            names = ["vec_id", "label", "codes", "error", "scanned"]
            if not last:
                width = x.shape[2] * PARTS
                vector = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * book.dim, pa.int32()),
                                                  pa.array(np.ascontiguousarray(x.reshape(n, width)[:, :book.dim]).ravel()))
                head += [vector, _binary(bounds), _binary(stamps)]
                names += ["vector", "bounds", "stamps"]
            yield pa.RecordBatch.from_arrays(head, names=names)


def _entry_sums(batches: Iterable[pa.RecordBatch], book: Codebook) -> Iterator[pa.RecordBatch]:
    """Per task: the sum of each entry's parts, component by component, in limbs
    of ``LIMB`` bits, and their number."""
    width = len(book.entries[0][0])
    total = np.zeros((PARTS, book.size, width), object)
    count = np.zeros((PARTS, book.size), np.int64)
    for batch in batches:
        x, codes = _matrix(batch.column("vector"), book.dim), _bytes(batch.column("codes"), np.uint8, (PARTS,))
        small = len(x) * float(np.abs(x).max() if x.size else 0) < 1 << 53
        for p in range(PARTS):
            count[p] += np.bincount(codes[:, p], minlength=book.size)
            if small:
                for k in range(width):
                    sums = np.bincount(codes[:, p], weights=x[:, p, k], minlength=book.size)
                    total[p, :, k] += sums.astype(np.int64).astype(object)
            else:
                np.add.at(total[p], codes[:, p], _big(x[:, p]))
    out = []
    for p, e in zip(*np.nonzero(count)):
        for k in range(width):
            v, limb = int(total[p, e, k]), 0
            while not -(1 << LIMB) < v < 1 << LIMB:
                out.append((int((p * book.size + e) * width + k), limb, v & ((1 << LIMB) - 1), 0))
                v, limb = v >> LIMB, limb + 1
            out.append((int((p * book.size + e) * width + k), limb, v, 0))
        out.append((int((p * book.size + e) * width), 0, 0, int(count[p, e])))
    cols = list(zip(*out)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["place", "limb", "total", "n"])


def _moved(state: DataFrame, book: Codebook) -> Codebook:
    """The codebook after its entries went to the floored mean of their parts."""
    sums = (state.select("vector", "codes").mapInArrow(lambda b: _entry_sums(b, book), "place long, limb long, total long, n long")
            .groupBy("place", "limb").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    width = len(book.entries[0][0])
    total, count = {}, {}
    for r in sums.toLocalIterator():  # at most 64 vectors' components
        total[r.place] = total.get(r.place, 0) + (r.total << (LIMB * r.limb))
        if r.n:
            count[r.place // width] = count.get(r.place // width, 0) + r.n

    def entry(at: int, old: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(total[at * width + k] // count[at] for k in range(width)) if at in count else old
    return Codebook(tuple(tuple(entry(p * book.size + e, old) for e, old in enumerate(part)) for p, part in enumerate(book.entries)), book.dim)


# ------------------------------------------------------------ the operator
def kept_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, vector (array of doubles) of the rows with a finite vector."""
    fine = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                              F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("vector").isNotNull() & (F.size("vector") > 0) & fine))


def first_codebook(kept: DataFrame, entries: int = ENTRIES) -> Codebook:
    """The parts of the least ``entries`` distinct vec_ids, ascending, of the
    vectors as long as the least vec_id's."""
    least = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    if not least:
        return Codebook((), 0)
    dim = len(least[0].vector)
    alike = kept.where(F.size("vector") == dim)
    ids = [r.vec_id for r in alike.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    known = [i for i in ids if i is not None]
    among = F.col("vec_id") <= max(known) if known else F.lit(False)
    if None in ids:
        among = among | F.col("vec_id").isNull()
    seeds = alike.where(among).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(F.asc_nulls_last("vec_id")).collect()
    x = quantise(_matrix(pa.array([r.vector for r in seeds], pa.list_(pa.float64())), dim))
    return Codebook(tuple(tuple(tuple(int(v) for v in e) for e in x[:, p]) for p in range(PARTS)), dim)


def encode(embeddings: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES,
           id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebook]:
    """(vec_id, label, codes binary, error long, scanned int: groups scanned in
    the last assignment) of every kept vector, and the final codebook. At most
    256 entries, as a code is a byte."""
    kept = kept_vectors(embeddings, id_col, vector_col, label_col)
    history = [first_codebook(kept, entries)]
    label = kept.schema["label"].dataType.simpleString()
    out = f"vec_id long, label {label}, codes binary, error long, scanned int"
    if not history[0].size:
        return embeddings.sparkSession.createDataFrame([], out), history[0]
    state = kept.where(F.size("vector") == history[0].dim)
    for t in range(rounds + 1):
        drift = [net_displacement(old, history[-1]) for old in history[:-1]]
        last = t == rounds
        step = (lambda h, d, z: lambda b: _round(b, h, d, z))(list(history), drift, last)
        state = materialise(state.mapInArrow(step, out if last else out + ", vector array<double>, bounds binary, stamps binary"), "vector_codes")
        if not last:
            history.append(_moved(state, history[-1]))
    return state, history[-1]


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, its errors summed over equal labels (NULLs together)."""
    totals = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)"))
                                        .cast("long").alias("label_error")).withColumnRenamed("label", "__label")
    totals = materialise(totals, "label_errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def _decode(batches: Iterable[pa.RecordBatch], book: Codebook) -> Iterator[pa.RecordBatch]:
    table = book.array() / 256.0
    for batch in batches:
        codes = _bytes(batch.column("codes"), np.uint8, (PARTS,))
        x = np.stack([table[p][codes[:, p]] for p in range(PARTS)], 1).reshape(len(codes), -1)[:, :book.dim]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(x), pa.list_(pa.float64()))], names=["vec_id", "vector"])


def decode(coded: DataFrame, book: Codebook) -> DataFrame:
    """(vec_id, vector): each code's entries, as components of the given scale."""
    return coded.select("vec_id", "codes").mapInArrow(lambda b: _decode(b, book), "vec_id long, vector array<double>")


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, code (hex, two digits a part), error, label_error, codebooks_sha256."""
    coded, book = encode(embeddings)
    return with_label_error(coded).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                                          F.lit(book.sha256()).alias("codebooks_sha256"))
