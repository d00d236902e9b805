from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from burnlens.llm import common as C

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t\x0bé中\x1c", max_size=30)), max_size=8)


def chunks(texts, size=C.CHUNK_BYTES):
    return C.text_chunks([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])], max_bytes=size)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_and_lines_are_those_of_the_text(texts):
    words, lines = [], []
    for _, data, off in chunks(texts, 16):
        raw = bytes(data)
        for spans, out in ((C.word_spans(data, off), words), (C.line_spans(data, off), lines)):
            starts, ends, bounds = spans
            for a, b in zip(bounds[:-1], bounds[1:]):
                out.append([raw[x:y].decode() for x, y in zip(starts[a:b], ends[a:b])])
    assert words == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert lines == [(t or "").split("\n") for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_equal_hashes_are_equal_words(texts):
    words, hashes = [], []
    for _, data, off in chunks(texts):
        starts, ends, _ = C.word_spans(data, off)
        words += [bytes(data[a:b]) for a, b in zip(starts, ends)]
        hashes += C.span_hashes(data, starts, ends).tolist()
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


def test_shingles_of_short_texts():
    bounds = np.array([0, 0, 1, 3, 8])
    h, at = C.shingle_hashes(np.arange(1, 9, dtype=np.uint64), bounds, 3)
    assert np.diff(at).tolist() == [0, 1, 1, 3] and len(set(h.tolist())) == 5


def test_long_text_is_a_chunk_of_its_own():
    got = [len(d) for _, d, _ in chunks(["ab", "c" * 50, "d", "e"], 10)]
    assert got == [2, 50, 2]


def test_a_chunk_takes_little_memory():
    """The features of 12 MB of texts, a chunk at a time, never hold many times a chunk."""
    import tracemalloc
    from burnlens.llm import classifier
    texts = pa.array(["Some words | of 3 lines\nand more # words " * 60] * 5000)
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    tracemalloc.start()
    rows = sum(len(classifier.text_features(raw, off)) for _, raw, off in C.text_chunks([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 5000 and peak < 100e6
