from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from burnlens.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx", s, 1, 2, 3, "b") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size long, start long, block string")


def expected_targets(sizes):
    """Water filling by bisection over the words per weight."""
    weight = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    total, lo, hi = Fraction(3, 2) * sum(sizes), Fraction(0), Fraction(2 * sum(sizes) + 1)
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(mid * w, 2 * n) for w, n in zip(weight, sizes)) < total:
            lo = mid
        else:
            hi = mid
    return [float(min(hi * w, 2 * n)) for w, n in zip(weight, sizes)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5], [0, 7, 0, 9], [5], [0, 0], [], [100, 1, 1, 1, 1, 1, 1], [3, 1, 2, 3, 1, 2]])
def test_targets(sizes):
    assert [float(t) for t in M.targets(sizes)] == pytest.approx(expected_targets(sizes))
    assert all(t <= 2 * n for t, n in zip(M.targets(sizes), sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    x = np.arange(n)
    p = M.permute(x, np.full(n, n), np.full(n, 12345, np.uint64))
    assert sorted(p.tolist()) == x.tolist()
    assert (M.permute(p, np.full(n, n), np.full(n, 12345, np.uint64), inverse=True) == x).all()
    if n >= 1000:
        assert abs(np.corrcoef(x, p)[0, 1]) < 0.1 and (p != M.permute(x, np.full(n, n), np.full(n, 54321, np.uint64))).mean() > 0.9


@pytest.mark.parametrize("size,block", [(1, 4), (4, 4), (5, 4), (23, 4), (64, 8), (65, 8)])
def test_slots_meet_the_words(size, block):
    blocks = -(-size // block)
    key = lambda e: M._key(7, [0], [e])
    for words in range(2 * size + 1):
        n, cut = M.slots_for(words, size, block, key)
        held = []
        for k in range(n):
            b = int(M.permute([k % blocks], [blocks], key(k // blocks))[0])
            held.append(min(block, size - b * block))
        assert sum(held[:-1]) + (cut if n else 0) == words and (not n or 0 < cut <= held[-1])


def test_draws_add_up_and_look_alike():
    out = M.draws([30_000, 10_000, 20_000, 0, 1], 50, 1)
    assert out.sum(0).tolist() == [30_000, 10_000, 20_000, 0, 1] and len(set(out.sum(1).tolist())) <= 2
    assert (abs(out[:, 0] / out.sum(1) - 0.5) < 0.1).all() and len(set(out[:, 0].tolist())) > 10
    assert (out == M.draws([30_000, 10_000, 20_000, 0, 1], 50, 1)).all()


def check(docs, rows, **how):
    got = docs.sparkSession.createDataFrame(M.taken(docs, **how).toPandas()).collect() if rows else M.taken(docs, **how).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    goal = dict(zip(order, expected_targets([sizes[s] for s in order])))
    want = sorted(((i, len(WORD.findall(t or "")), sizes[s], round(goal[s], 6)) for i, t, s in rows), key=str)
    num = lambda x: None if x is None or x != x else int(x)
    assert sorted(((num(r.doc_id), r["size"], r.source_size, round(r.target, 6)) for r in got), key=str) == want
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    return got, goal


def test_whole_table(spark, data):
    docs = data("documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got, goal = check(docs, rows)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 0.5 for s, t in goal.items())  # to the word
    again = {r.doc_id: r.taken for r in M.taken(docs.repartition(11)).collect()}
    assert again == {r.doc_id: r.taken for r in got}


ROWS = [(1, None, "a"), (2, "", "a"), (3, " \t\n", "empty"), (4, "one", ""), (5, " ".join(f"w{i}" for i in range(30_000)), "b"), (6, "x y z " * 50, "b"),
        (6, "x y z " * 50, "b"), (6, "other text", "b"), (None, "no id", "c"), (None, "no id", "c"), (None, "no id", None), (8, "é 中 \U0001f600 " * 40, None),
        (9, "k " * 5000, "Z"), (10, "k " * 4000, "a")]


def test_odd_rows(spark):
    got, goal = check(frame(spark, ROWS), ROWS)
    assert goal["empty"] == 0
    by_size = Counter()
    for r in got:
        by_size[r.source_size] += r.taken
    sizes = {s: sum(len(WORD.findall(t or "")) for _, t, x in ROWS if x == s) for s in goal}
    assert len(set(sizes.values())) == len(sizes) and all(abs(by_size[n] - goal[s]) <= 0.5 for s, n in sizes.items())
    assert check(frame(spark, ROWS[:3]), ROWS[:3])[1] == {"a": 0.0, "empty": 0.0}
    assert M.taken(frame(spark, [])).collect() == [] and M.mix(frame(spark, []))[0].collect() == []


def test_mix_is_whole_blocks_in_order(spark):
    """A small mix read back: every slot is one block of its source's stream."""
    rows = [(i, " ".join(f"{'abc'[i % 3]}{i}_{k}" for k in range(5 + 7 * i % 40)), "abc"[i % 3]) for i in range(60)]
    docs = frame(spark, rows)
    pieces, documents = M.mix(docs, block=16, shards=4, seed=3)
    stream = {}
    for r in sorted(documents.collect(), key=lambda r: (r.source, r.start)):
        stream.setdefault(r.source, []).extend(next(t for i, t, _ in rows if i == r.doc_id).split())
        assert len(stream[r.source]) == r.start + r["size"]
    blocks = {s: {tuple(w[k:k + 16]) for k in range(0, len(w), 16)} for s, w in stream.items()}
    text = {}
    for r in sorted(M.texts(docs, pieces).collect(), key=lambda r: (r.shard, r.slot, r.at)):
        at = text.setdefault((r.shard, r.slot), [])
        assert len(at) == r.at
        at.extend(r.text.split(" "))
    cut = [tuple(w) for w in text.values() if tuple(w) not in blocks[w[0][0]]]
    assert len(cut) <= 3 and all(any(b[:len(w)] == w for b in blocks[w[0][0]]) for w in cut)  # the last slots
    shards = Counter(s for s, _ in text)
    assert len(shards) == 4 and max(shards.values()) - min(shards.values()) <= 1
    assert all(sorted(k for s, k in text if s == x) == list(range(n)) for x, n in shards.items())
    per = {x: Counter(w[0][0] for (s, _), w in text.items() if s == x) for x in shards}
    assert all(len(c) == 3 for c in per.values())  # every shard holds every source
    uses = Counter(tuple(w) for w in text.values())
    assert max(uses.values()) <= 2
