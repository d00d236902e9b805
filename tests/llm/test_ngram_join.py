from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from burnlens.llm import ngram_join as N
from burnlens.llm.graph import components
from tests_llm_prose import prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    own = {i: i for i in sets}
    for _ in range(len(own)):
        for a, b in links:
            own[a] = own[b] = min(own[a], own[b])
    return {i: (len(sets[i]), own[i]) for i in sets}


def got(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.join(docs).collect()}


def test_table_against_brute_force(data):
    docs = data("documents")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_frequent_passages_and_near_copies(spark, make_docs, monkeypatch):
    """Hot n-grams go through more than one step, and no link is lost."""
    monkeypatch.setattr(N, "star_pairs", lambda nodes, m: nodes.select(nodes.id.alias("a"), nodes.id.alias("b")).limit(0))
    shared = prose(1, 40).replace("\n", " ")
    rows = [(i, shared + " " + prose(100 + i % 9, 30).replace("\n", " ")) for i in range(18)]
    base = prose(3, 120).split()
    for i in range(8):  # a chain of near copies, and one text in other case
        w = list(base)
        w[10 * i] = "changed"
        w[10 * i + 10] = "Other"
        rows.append((50 + i, " ".join(w)))
    rows += [(70, " ".join(base).upper()), (71, None), (72, ""), (73, "a b"), (74, "A  B"), (75, "a b c")]
    docs = make_docs(rows)
    parts = spark.createDataFrame([], "id long, component long")
    texts = N.id_text(docs)
    info = N.describe(texts).where("n > 0")
    nodes = info.groupBy("fp", "fp2", "n").agg({"doc_id": "min", "sig": "first"}).withColumnsRenamed({"min(doc_id)": "id", "first(sig)": "sig"})
    steps = list(N.prefix_pairs(texts, N.materialise(nodes, "n"), parts, N.Measure(), light=4))
    assert len(steps) > 1
    assert got(docs) == brute(rows)


def test_odd_rows(odd, no_docs):
    out = [(r.doc_id, r.n_shingles, r.component_id) for r in N.join(odd).collect()]
    assert len(out) == odd.count()
    by = {i: (n, c) for i, n, c in out}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4) and by[7] == by[6] and by[6][1] == 6
    assert N.join(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_trees_and_bitmaps(seed):
    r, m = np.random.default_rng(seed), N.Measure()
    base = np.unique(r.integers(0, 2**63, 600).astype(np.uint64))
    others = [np.unique(np.concatenate([base[r.random(len(base)) < q], r.integers(0, 2**63, k).astype(np.uint64)]))
              for q in (1, 0.99, 0.95, 0.9, 0.8, 0.3) for k in (0, 5, 40, 90)]
    want = [100 * len(np.intersect1d(base, o)) >= 85 * len(np.union1d(base, o)) for o in others]
    assert N.tree_overlaps(base, others, m) == want
    assert all(N.may_link(N.bitmap(base).tobytes(), len(base), N.bitmap(o).tobytes(), len(o), m) for o, w in zip(others, want) if w)


def test_parity_signatures_bound_the_difference(spark):
    r = np.random.default_rng(1)
    base = np.unique(r.integers(0, 2**63, 130).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[r.random(len(base)) < q], r.integers(0, 2**63, k).astype(np.uint64)]))
            for q in (1, 0.98, 0.9) for k in (0, 3, 12)] + [base[:1], base[:0]]
    sigs = N.parities(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])).to_pylist()
    assert len({len(x) for x in sigs}) > 1
    near = [(i, j) for i in range(9) for j in range(9) if len(sigs[i]) <= 2 * len(sigs[j]) and len(sigs[j]) <= 2 * len(sigs[i])] + [(9, 10)]
    rows = spark.createDataFrame([(i, j, sigs[i], sigs[j]) for i, j in near], "i int, j int, x array<long>, y array<long>")
    for x in rows.select("i", "j", N.differing(rows.x, rows.y).alias("d")).collect():
        apart = len(np.setxor1d(sets[x.i], sets[x.j]))
        assert apart * 0.6 - 1 <= x.d <= apart, (x, apart)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    out = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        out[r.component].add(r.id)
    assert out == {0: set(range(41)), 100: set(range(100, 160)), 200: {200, 201}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_sets_have_short_signatures(spark):
    r = np.random.default_rng(2)
    one = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64))
    sets = [one, one[r.random(len(one)) < 0.95], one[:300]]
    sigs = N.parities(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])).to_pylist()
    assert [len(x) for x in sigs[:2]] == [N.SIGNATURE] * 2
    rows = spark.createDataFrame([(0, 0, 1, sigs[0], sigs[1])], "k int, i int, j int, x array<long>, y array<long>")
    assert rows.select(N.differing(rows.x, rows.y).alias("d")).first().d <= len(np.setxor1d(sets[0], sets[1]))
