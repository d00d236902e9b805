from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from burnlens.llm import packing as P


def check(rows, texts):
    """Every piece of every document, gapless sequences of at most 2048."""
    tok = Tokenizer.from_file(P.tokenizer_path())
    want = defaultdict(int)
    for doc, text in texts:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), P.LENGTH)):
            piece = ids[at:at + P.LENGTH]
            want[doc, k, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    got = defaultdict(int)
    held = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        held[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.LENGTH
    return len(held), sum(k[3] * n for k, n in want.items())


def test_whole_table(data):
    docs = data("documents")
    n, tokens = check(P.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= -(-tokens // P.LENGTH) + 1


def test_odd_rows(odd, no_docs):
    check(P.pack(odd, group=3).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert P.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_local_search_never_lowers_the_squared_fill(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 2048 if seed % 2 else 900, 400)
    bins = P.Bins(sizes, 2048)
    before = (sum(f * f for f in bins.fill), sum(1 for b in bins.bins if b))
    bins.search()
    assert sum(f * f for f in bins.fill) >= before[0] and sum(1 for b in bins.bins if b) <= before[1]
    assert sorted(i for b in bins.bins for i in b) == list(range(400))
    assert all(f == sum(int(sizes[i]) for i in b) <= 2048 for f, b in zip(bins.fill, bins.bins))


def test_exchange_empties_a_bin():
    bins = P.Bins(np.array([6, 4, 4, 3, 3, 3, 2, 5]), 10)
    bins.search()
    assert sum(1 for b in bins.bins if b) == 3


def test_text_that_the_fast_path_leaves():
    e = P.Encoder(P.tokenizer_path())
    texts = ["ΑΣ ΣΑΣ. İstanbul", "<|endoftext|> a<|startoftext|>b", "it's I'LL 'Re\tx\r\ny é ẞ ﬁ 中文 a1b22", "ŉ ſ ªº² ×÷", "é a b\x1cc", ""]
    assert e.encode(texts) == [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
