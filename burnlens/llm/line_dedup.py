"""Line dedup by pairwise alignment (operator 2).

Every line is hashed, and from each line the shortest run of adjacent lines that
has BLOCK_WORDS words; the first holder of a line or run is the document of
least id that has it. A later document is paired with the first holders of its
lines and runs, so each costs one pair per document however frequent it is, and
the first holder of a line never loses it. A block that an earlier document has
begins with such a run, so its later holders are paired with a document that
holds that run, also where each of its lines was first held elsewhere. Pairs that share too few words to hold a block are
dropped; the others are aligned with patience diff (lines unique on both sides
are anchors, the longest increasing run of them is kept, the gaps between are
aligned in the same way). Runs of aligned lines of at least BLOCK_WORDS words
are deleted from the later document.

A document whose words all went has ``kept`` false; its text is then empty.

Contract cases: NULL text is the empty text; blank lines align but never make a
pair; rows that share a doc_id are one document to the order (none loses lines
to another); an empty table gives an empty result; columns other than doc_id
and text are passed through, but for those named as the results are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from burnlens.llm.common import id_text, line_spans, materialise, run_hashes, span_hashes, text_chunks, word_spans

BLOCK_WORDS = 10


def _lines(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for rows, data, off in text_chunks(batches):
        starts, ends, bounds = line_spans(data, off)
        word_starts, _, _ = word_spans(data, off)
        words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
        h = span_hashes(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(words)])
        last = np.searchsorted(total, total[:-1] + least)  # the end of the shortest run from each line
        own = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        run = np.flatnonzero((words > 0) & (words < least) & (last <= bounds[own + 1]))
        run_at = np.searchsorted(run, bounds)
        at = pa.array(bounds.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.ListArray.from_arrays(at, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(words.astype(np.int32))),
             pa.ListArray.from_arrays(pa.array(run_at.astype(np.int32)), pa.array(run_hashes(h, run, last[run]).view(np.int64)))],
            names=["doc_id", "lines", "words", "runs"])


def hashed_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, lines (hashes, in order), words (of each line), runs (hashes of
    the shortest runs of two lines or more that have ``least`` words)."""
    return id_text(docs).mapInArrow(lambda b: _lines(b, least), "doc_id long, lines array<long>, words array<int>, runs array<long>")


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by first element, with increasing second ones."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of the lines that are unique in both; if there are none, of the
    k-th copy of a line in each."""
    ca, cb = Counter(a), Counter(b)
    place = {x: j for j, x in enumerate(b) if cb[x] == 1}
    found = [(i, place[x]) for i, x in enumerate(a) if ca[x] == 1 and x in place]
    if found:
        return found
    seen: Counter = Counter()
    copies = {}
    for j, x in enumerate(b):
        copies[x, seen[x]] = j
        seen[x] += 1
    seen.clear()
    for i, x in enumerate(a):
        if (x, seen[x]) in copies:
            found.append((i, copies[x, seen[x]]))
        seen[x] += 1
    return found


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal lines of a and b, both increasing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, low, high = todo.pop()
        while lo < hi and low < high and a[lo] == b[low]:
            out.append((lo, low))
            lo, low = lo + 1, low + 1
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            hi, high = hi - 1, high - 1
            out.append((hi, high))
        if lo == hi or low == high:
            continue
        run = _increasing(_anchors(a[lo:hi], b[low:high]))
        i, j = lo, low
        for x, y in run:
            x, y = x + lo, y + low
            out.append((x, y))
            todo.append((i, x, j, y))
            i, j = x + 1, y + 1
        if run:
            todo.append((i, hi, j, high))
    return sorted(out)


def common_blocks(a: list, b: list, words: list[int], least: int = BLOCK_WORDS) -> list[int]:
    """Lines of a in aligned blocks of at least ``least`` words."""
    out: list[int] = []
    block: list[int] = []
    before = (-2, -2)
    for i, j in [*patience(a, b), (len(a) + 2, len(b) + 2)]:
        if (i, j) != (before[0] + 1, before[1] + 1):
            if sum(words[k] for k in block) >= least:
                out += block
            block = []
        if i < len(a):
            block.append(i)
        before = (i, j)
    return out


def _align(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = [batch.column(n) for n in ("doc_id", "lines", "words", "first_lines")]
        found = [common_blocks(get[1][k].as_py(), get[3][k].as_py(), get[2][k].as_py(), least) for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([get[0], pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "places"])


def removals(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, places: the lines (from 0) to delete, for documents that lose any."""
    lines = materialise(hashed_lines(docs, least).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]), "lines")
    runs = F.transform("runs", lambda h: F.struct(h.alias("h"), F.lit(least).alias("n")))
    each = lines.select("doc_id", F.explode(F.array_distinct(F.concat(F.arrays_zip(F.col("lines").alias("h"), F.col("words").alias("n")), runs))).alias("x"))
    each = each.select("doc_id", F.col("x.h").alias("h"), F.col("x.n").alias("n")).where("n > 0")
    holder = each.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("final")).where("first < final").select("h", "first")
    pairs = (each.join(holder, "h").where("first < doc_id").groupBy("doc_id", "first")
             .agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("doc_id", "first"))
    met = (pairs.join(lines, "doc_id")
           .join(lines.select(F.col("doc_id").alias("first"), F.col("lines").alias("first_lines")), "first"))
    found = met.select("doc_id", "lines", "words", "first_lines").mapInArrow(lambda b: _align(b, least), "doc_id long, places array<int>")
    return (found.where(F.size("places") > 0).groupBy("doc_id")
            .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, places = batch.column("text"), batch.column("__places")
        out, n, kept = [], [], []
        for k in range(batch.num_rows):
            t, gone = text[k].as_py() or "", places[k].as_py()
            if not gone:
                out.append(text[k].as_py())
                n.append(t.count("\n") + 1)
                kept.append(True)
                continue
            lines, drop = t.split("\n"), set(gone)
            t = "\n".join(x for i, x in enumerate(lines) if i not in drop)
            kept.append(any(c not in " \t\n\x0b\x0c\r" for c in t))
            out.append(t if kept[-1] else "")
            n.append(len(lines))
        cols = [batch.column(i) for i in range(batch.num_columns)]
        cols[batch.schema.get_field_index("text")] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(kept, pa.bool_())], names=[*batch.schema.names, "n_lines", "kept"])


def dedup(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the common blocks cut from ``text``, and n_lines (before),
    n_removed, kept."""
    gone = materialise(removals(docs, least), "removals").select(F.col("doc_id").alias("__id"), F.col("places").alias("__places"))
    # The removals grow with the documents: a merge join at every size.
    rows = docs.drop("n_lines", "n_removed", "kept").join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col("__id"), "left").drop("__id")
    rows = rows.withColumn("text", F.col("text").cast("string"))
    cut = rows.mapInArrow(_cut, StructType([*rows.schema.fields, StructField("n_lines", LongType()), StructField("kept", BooleanType())]))
    return cut.withColumn("n_removed", F.coalesce(F.size("__places"), F.lit(0)).cast("long")).drop("__places")
