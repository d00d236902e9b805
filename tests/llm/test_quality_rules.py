from __future__ import annotations

import itertools
import re
from collections import Counter

from pyspark.sql import functions as F

from burnlens.llm import quality_rules as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(covered)


def same(docs):
    rows = Counter((r.doc_id, *(r[m] for m in Q.METRICS), r.base_failed) for r in Q.apply(docs).collect())
    want = Counter()
    for r in docs.collect():
        m = brute(r.text)
        want[r.doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]] += 1
    assert rows == want


def test_metrics_against_brute_force(data):
    same(data("documents"))


def test_odd_rows(odd, no_docs, make_docs):
    same(odd)
    assert Q.apply(no_docs).count() == 0
    repeats = [(1, "a a a"), (2, "a a a a"), (3, "a b c a b c"), (4, "a b c x a b c"), (5, "x\nx\n \n \ny"), (6, "a b")]
    same(make_docs(repeats))


def test_kept_rows_can_be_filtered(data):
    """A filter on the result must not blow the expressions up."""
    out = Q.apply(data("documents"))
    assert out.where("kept").count() + out.where("not kept").count() == out.count()


def test_verdict_does_not_depend_on_the_order(data):
    rules = Q.default_rules()
    docs = Q.measured(data("documents"))
    orders = [rules, rules[::-1], rules[3:] + rules[:3]]
    got = docs.select(*(Q.cascade(o).alias(f"k{i}") for i, o in enumerate(orders))).distinct().collect()
    assert all(len(set(r)) == 1 for r in got)


def test_order_is_by_rejection_per_cost():
    a, b, c = (Q.Rule(n, F.lit(False)) for n in "abc")
    assert [r.name for r in Q.order([(a, 2.0, 0.2), (b, 1.0, 0.3), (c, 0.1, 0.02)])] == ["b", "c", "a"]


def test_labelled_quality(data):
    rows = Q.apply(data("documents")).join(data("labels"), "doc_id").where("not base_failed").collect()
    assert rows and sum(r.kept == (r.quality == 1) for r in rows) >= 0.97 * len(rows)


def test_each_rule_rejects_its_case(make_docs):
    words = [f"{a}{b}{c}" for a, b, c in itertools.product("bcdfg", "aeiou", "lmnrst")]
    base = " ".join(words[:100])
    cases = {"clean": base, "symbols": " ".join(x + "$$" for x in words[:100]), "word_length": " ".join(x * 6 for x in words[:100]),
             "shouting": base.upper(), "exclamation": " ".join(x + "!!" for x in words[:100])}
    out = {r.doc_id: r.kept for r in Q.apply(make_docs(list(enumerate(cases.values())))).collect()}
    assert [out[i] for i in range(len(cases))] == [True, False, False, False, False]
