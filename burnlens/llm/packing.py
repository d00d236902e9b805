"""Best-fit packing with swap-based local search (operator 3).

Documents become token ids; a document longer than a sequence is cut into
sequence-long pieces. Full pieces are sequences of their own. The rest are
dealt by hash into groups of about ``GROUP`` pieces (a group's waste is at most
a few part-filled sequences, so the loss is below one sequence in thousands),
and each group is packed on its own: best fit over decreasing lengths, then
local search between underfull bins - move a document, exchange one for one, or
two for one - wherever that raises the sum of squared fills; bins that run empty
go. The search makes at most 6 passes and tries the 6 largest fitting sizes, 16 items of a size and
the 8 largest items of a bin: that bounds its time, every piece is packed.

Contract cases: NULL text is the empty text (one token, the separator); equal
texts and repeated rows are packed each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import id_text, materialise

LENGTH = 2048
SEPARATOR = 0
GROUP = 16384        # pieces packed together
CACHE_BYTES = 160 << 20  # what a task keeps of encoded strings, in each of two maps; nothing is kept after it
ENTRY_BYTES = 200       # of a map's entry, besides its characters and ids
TOKENIZER = "word_bpe_49k.json"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"

_encoder: dict = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: The tokenizer's own split of lower-cased text, and the texts to which it is
#: applied here: Latin letters, digits and signs, where Unicode normal forms and
#: versions don't matter.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = "[\t\n\r\x20-\x7e\u00a1-\u012f\u0131-\u017f]*"


class Encoder:
    """Token ids of a text as little-endian uint32 bytes.

    The tokenizer's pre-tokenizer never joins characters across white space,
    so a text's ids are those of its space- and newline-delimited strings in
    order. A string not in the cache is split into its pre-tokens, and only
    pre-tokens not seen yet go through the tokenizer, many at a time: each ends
    with a token that carries the end-of-word mark. Texts that hold other than
    plain Latin characters, or what may be a special token, are encoded whole."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRE_TOKENS).findall
        self.plain = regex.compile(PLAIN).fullmatch
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.cache: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.cache_bytes = self.parts_bytes = 0

    def _encode_parts(self, parts: list[str]) -> None:
        for lo in range(0, len(parts), 20_000):
            some = parts[lo:lo + 20_000]
            lines = [" ".join(some[k:k + 200]) for k in range(0, len(some), 200)]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                raise ValueError("the tokenizer doesn't mark the ends of its pre-tokens")
            raw = ids.tobytes()
            self.parts.update(zip(some, (raw[4 * a:4 * b] for a, b in zip([0, *cuts], cuts))))
            self.parts_bytes += ENTRY_BYTES * len(some) + len(raw) + sum(map(len, some))

    def _add(self, new: set[str]) -> None:
        split = {s: (s,) if s.isalpha() else self.split(s) for s in new}
        missing = set().union(*split.values()).difference(self.parts)
        if missing:
            self._encode_parts(list(missing))
        get = self.parts.__getitem__
        for s, p in split.items():
            ids = self.cache[s] = get(p[0]) if len(p) == 1 else b"".join(map(get, p))
            self.cache_bytes += ENTRY_BYTES + len(s) + (len(ids) if len(p) > 1 else 0)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.lower().replace("\n", " ").split(" ") if self.plain(t) and "<|" not in t else None for t in texts]
        if self.cache_bytes > CACHE_BYTES or self.parts_bytes > CACHE_BYTES:
            self.clear()
        new = set().union(*(s for s in split if s is not None)).difference(self.cache)
        if new:
            self._add(new)
        get = self.cache.__getitem__
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if s is None else b"".join(map(get, s))
                for t, s in zip(texts, split)]


def _pieces(batches: Iterable[pa.RecordBatch], path: str, length: int) -> Iterator[pa.RecordBatch]:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoder:
        _encoder[path] = Encoder(path)
    encoder = _encoder[path]
    gc.disable()  # the maps' many strings hold no cycles
    try:
        yield from _cut(batches, encoder, length)
    finally:
        encoder.clear()  # the worker goes on to other stages
        gc.enable()


def _cut(batches: Iterable[pa.RecordBatch], encoder: Encoder, length: int) -> Iterator[pa.RecordBatch]:
    end = np.array([SEPARATOR], "<u4").tobytes()
    for batch in batches:
        out: list[tuple] = []
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    piece = ids[at:at + 4 * length]
                    out.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])


def tokenize(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    path = path or tokenizer_path()
    return id_text(docs).mapInArrow(lambda b: _pieces(b, path, length), PIECES)


class Bins:
    """Bins of one group, with the items of underfull bins indexed by size."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.size = [int(s) for s in sizes]
        self.capacity = capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []
        self.home = [0] * len(self.size)
        self._best_fit()
        self.index: dict[int, set[int]] = {}
        self.mask = 0
        for b, items in enumerate(self.bins):
            if self.fill[b] < capacity:
                for i in items:
                    self._list(i)

    def _best_fit(self) -> None:
        """Best fit decreasing: the tightest bin with room, by a bit mask over free lengths."""
        free: dict[int, list[int]] = {}
        mask = 0
        for i in sorted(range(len(self.size)), key=lambda i: -self.size[i]):
            s = self.size[i]
            room = mask >> s
            if room:
                gap = s + (room & -room).bit_length() - 1
                b = free[gap].pop()
                if not free[gap]:
                    mask &= ~(1 << gap)
            else:
                gap, b = self.capacity, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append(i)
            self.fill[b] += s
            self.home[i] = b
            if gap > s:
                free.setdefault(gap - s, []).append(b)
                mask |= 1 << (gap - s)

    def _list(self, i: int) -> None:
        self.index.setdefault(self.size[i], set()).add(i)
        self.mask |= 1 << self.size[i]

    def _unlist(self, i: int) -> None:
        own = self.index.get(self.size[i])
        if own is not None:
            own.discard(i)
            if not own:
                del self.index[self.size[i]]
                self.mask &= ~(1 << self.size[i])

    def _shift(self, give: list[int], take: list[int], a: int, b: int) -> None:
        """Items ``give`` go from a to b, items ``take`` from b to a."""
        for x in give:
            self.bins[a].remove(x)
            self.bins[b].append(x)
            self.home[x] = b
        for y in take:
            self.bins[b].remove(y)
            self.bins[a].append(y)
            self.home[y] = a
        d = sum(self.size[y] for y in take) - sum(self.size[x] for x in give)
        self.fill[a] += d
        self.fill[b] -= d
        if self.fill[a] == self.capacity:
            for x in self.bins[a]:
                self._unlist(x)

    def _find(self, a: int, most: int, above: int, tries: int = 6) -> int | None:
        """The largest item of another underfull bin, of length in (above, most], that raises the squared fill."""
        mask = self.mask & ((1 << (most + 1)) - 1)
        while mask and tries:
            s = mask.bit_length() - 1
            if s <= above:
                return None
            best = None
            for k, y in enumerate(self.index[s]):
                b = self.home[y]
                if b != a and s - above > self.fill[b] - self.fill[a] and (best is None or self.fill[b] < self.fill[self.home[best]]):
                    best = y
                if k >= 16 and best is not None:
                    break
            if best is not None:
                return best
            mask &= ~(1 << s)
            tries -= 1
        return None

    def _improve(self, a: int) -> bool:
        """One move or exchange that raises the squared fill of bin ``a`` and its partner."""
        gap = self.capacity - self.fill[a]
        options = []  # (gain in a's fill, items given, items taken)
        y = self._find(a, gap, 0)
        if y is not None:
            options.append((self.size[y], [], [y]))
        own = {self.size[x]: x for x in self.bins[a]}
        for s, x in own.items():
            y = self._find(a, s + gap, s)
            if y is not None:
                options.append((self.size[y] - s, [x], [y]))
                b = self.home[y]  # two of b for x: y stays, or y with a smaller one
                rest = [z for z in self.bins[b] if z != y and 0 < self.size[z] + self.size[y] - s <= gap]
                if rest:
                    z = max(rest, key=lambda z: self.size[z])
                    d = self.size[z] + self.size[y] - s
                    if d > self.fill[b] - self.fill[a]:
                        options.append((d, [x], [y, z]))
        items = sorted(self.bins[a], key=lambda x: -self.size[x])[:8]
        for k, x in enumerate(items):
            for z in items[k + 1:]:
                s = self.size[x] + self.size[z]
                y = self._find(a, s + gap, s, 2)
                if y is not None:
                    options.append((self.size[y] - s, [x, z], [y]))
        if not options:
            return False
        _, give, take = max(options, key=lambda o: o[0])
        self._shift(give, take, a, self.home[take[0]])
        return True

    def search(self, passes: int = 6) -> None:
        for _ in range(passes):
            better = False
            order = sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity), key=lambda b: -self.fill[b])
            for a in order:
                while 0 < self.fill[a] < self.capacity and self._improve(a):
                    better = True
            if not better:
                return


def pack_group(rows: pd.DataFrame, capacity: int = LENGTH) -> pd.DataFrame:
    """sequence_id (from 0 within the group) and offset of each piece."""
    bins = Bins(rows["length"].to_numpy(), capacity)
    bins.search()
    seq = np.zeros(len(rows), np.int64)
    off = np.zeros(len(rows), np.int64)
    n = 0
    for items in bins.bins:
        if items:
            at = 0
            for i in sorted(items):
                seq[i], off[i] = n, at
                at += bins.size[i]
            n += 1
    return rows.assign(sequence_id=seq, offset=off)


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialise(tokenize(docs, path, length), "packing_pieces")
    whole = pieces.where(F.col("length") == length)
    part = pieces.where(F.col("length") < length)
    groups = max(1, -(-part.count() // group))
    names = [c.strip().split()[0] for c in PACKED.split(",")]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g = int(rows["g"].iloc[0])
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True]).reset_index(drop=True)
        out = pack_group(rows, length)
        out["sequence_id"] += g << 32
        return out[names]

    dealt = part.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    packed = dealt.groupBy("g").applyInPandas(run, PACKED)
    alone = whole.select("*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.select(names).unionByName(packed)
