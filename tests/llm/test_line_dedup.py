from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from burnlens.llm import line_dedup as L

LONG = "this line has quite enough words to be a block by itself {}"


def result(docs):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed, r.kept) for r in L.dedup(docs).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns_equal_lines_in_order(a, b):
    out = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in out)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(out, out[1:]))
    if a == b:
        assert out == [(i, i) for i in range(len(a))]


def test_long_common_parts_are_found():
    r = random.Random(1)
    a = [r.random() for _ in range(500)]
    b = a[:100] + [r.random() for _ in range(50)] + a[200:]
    assert len(L.patience(a, b)) == 400


def test_blocks_go_from_the_later_document(make_docs):
    lines = [LONG.format(i) for i in range(6)]
    docs = make_docs([(1, "\n".join(lines)), (2, "new\n" + "\n".join(lines[1:4]) + "\nend"), (3, "\n".join(lines[::-1])),
                      (4, "\n".join(lines)), (5, "short line\nother"), (6, "short line\nelse")])
    out = {i: (t, n, gone, kept) for i, t, n, gone, kept in result(docs)}
    assert out[1] == ("\n".join(lines), 6, 0, True)
    assert out[2] == ("new\nend", 5, 3, True)
    assert out[3][2] == 1  # in reverse order one line aligns
    assert out[4] == ("", 6, 6, False)
    assert out[5][2] == out[6][2] == 0  # a block too short


def test_a_block_whose_lines_were_first_held_apart(make_docs):
    a, b = "six words are in this line", "and five are in this"
    docs = make_docs([(1, a + "\nsomething else"), (2, "another thing\n" + b), (3, f"x\n{a}\n{b}\ny"), (4, f"z\n{a}\n{b}\nw"),
                      (5, f"{a}\n\n{b}"), (6, f"q\n{a}\n\n{b}")])
    out = {i: (t, gone) for i, t, _, gone, _ in result(docs)}
    assert out[4] == ("z\nw", 2) and out[6] == ("q", 3)
    assert all(out[i][1] == 0 for i in (1, 2, 3, 5))


def test_every_line_survives_in_its_first_holder(data):
    docs = data("documents")
    before = {r.doc_id: (r.text or "").split("\n") for r in docs.collect()}
    after = {i: t.split("\n") for i, t, *_ in result(docs)}
    first = {}
    for i in sorted(before):
        for line in before[i]:
            first.setdefault(line, i)
    assert all(line in after[i] for line, i in first.items() if line.strip())
    assert sum(map(len, after.values())) < sum(map(len, before.values()))


def test_odd_rows(odd, no_docs):
    out = L.dedup(odd)
    assert out.columns[:5] == odd.columns[:5] and out.count() == odd.count()
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text is None and by[1].kept and by[2].kept and by[7].kept is False and by[6].kept
    assert L.dedup(no_docs).count() == 0
