"""Shared helpers of the llm operators: tables written to the cluster's shared
folder, and numpy views of Arrow text.

The text helpers work on the UTF-8 buffer of an Arrow string column, a few MB
at a time, so no Python string is made per word and memory is bounded by the
chunk size (one document longer than that is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.session import scratch_path

CHUNK_BYTES = 1 << 19
#: The white space of the word contract: space, and 0x09 to 0x0D.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage
    is cut there, and a lost executor costs no recomputation of ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): NULL text is the empty text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


# ------------------------------------------------------------ Arrow text
def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array, without copying the bytes."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw[:0], off - off[0] if len(off) else np.zeros(1, np.int64)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows with at most ``max_bytes`` of
    text each; a longer single text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = string_buffers(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True


#: Gaps between words of ASCII letters and digits and of any non-ASCII character.
LETTER_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (by default ``[^\\x20\\x09-\\x0D]+``) of each text: byte starts, byte
    ends, and bounds (n + 1): the words of text i are bounds[i]:bounds[i + 1]."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~gaps[data]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start = ink.copy()
    start[1:] &= ~ink[:-1]
    start[first] |= ink[first]
    end = ink.copy()
    end[:-1] &= ~ink[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] |= ink[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines (split at \\n) of each text; an empty text has one empty line."""
    cuts = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], cuts + 1])
    ends = np.concatenate([cuts, offsets[1:]])
    own = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cuts, "right") - 1])
    end_own = np.concatenate([own[len(offsets) - 1:], np.arange(len(offsets) - 1)])
    a, b = np.lexsort((starts, own)), np.lexsort((ends, end_own))
    return starts[a], ends[b], np.searchsorted(own[a], np.arange(len(offsets)))


_rng = np.random.Generator(np.random.PCG64(20240607))
#: A random odd 64-bit value for each byte; the base of the polynomial and its inverse modulo 2**64.
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
_BASE = int(_rng.integers(0, 2**64, dtype=np.uint64)) & ~7 | 5
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """64-bit hash of each byte span (a polynomial over random byte values)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of a sequence of hashes, by its values and their order."""
    up, down = _powers(len(values) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position of each text, in order, and the
    bounds by text. Texts of fewer than k words (but one at least) have one
    shingle, the whole sequence; texts without words none."""
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    if not out_bounds[-1]:
        return np.zeros(0, np.uint64), out_bounds
    at = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], count)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    short = np.repeat(np.where(n < k, n, k), count)
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        piece = padded[at + j]
        if (n < k).any():
            piece = np.where(j < short, piece, np.uint64(0))
        h = h * np.uint64(0x2545F4914F6CDD1D) + piece
    return mix(h + short.astype(np.uint64)), out_bounds


def per_text_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each [offsets[i], offsets[i + 1])."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
