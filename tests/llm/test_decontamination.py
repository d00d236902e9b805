from __future__ import annotations

import random

import pytest

from burnlens.llm import decontamination as D
from tests_llm_prose import prose

ITEMS = "item_id long, text string, cosine double, doc_id long"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 0.0, 5) for i, t in rows], ITEMS)


def pairs(docs, bench):
    return {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}


def test_table_against_brute_force(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    norm = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t).split()).lower()
    held = {r.doc_id: f" {norm(r.text)} " for r in docs.collect()}
    want = {(d, r.item_id) for r in bench.collect() for d, t in held.items() if f" {norm(r.text)} " in t}
    got = pairs(docs, bench)
    assert want and want <= got and len(got - want) <= 0.1 * len(got)


def test_paraphrases_and_clean_documents(spark, make_docs):
    r = random.Random(3)
    bench = [(i, prose(i, 40).replace("\n", " ")) for i in range(20)]
    rows = []
    for i, t in bench:
        w = [x if r.random() > 0.15 or k >= 32 else "other" for k, x in enumerate(t.split())]
        rows.append((i, prose(100 + i, 200) + " " + " ".join(w) + " " + prose(200 + i, 200)))
        rows.append((50 + i, prose(300 + i, 400)))
        rows.append((80 + i, prose(400 + i, 100) + " " + " ".join(t.split()[:12]) + " " + prose(500 + i, 100)))
    got = pairs(make_docs(rows), items(spark, bench))
    assert sum((i, i) in got for i in range(20)) >= 18 and not [p for p in got if p[0] >= 50]


def test_a_leak_copied_to_a_third_of_the_rows(spark, make_docs):
    leak = prose(7, 40)
    copies = [(i, prose(50, 20) + " " + leak + " " + prose(51, 20)) for i in range(40)]
    got = pairs(make_docs(copies + [(100 + i, prose(1000 + i, 80)) for i in range(80)]), items(spark, [(1, leak), (2, prose(8, 40))]))
    assert got == {(i, 1) for i in range(40)}


@pytest.mark.parametrize("n_items, lengths", [(40, (8, 12, 40, 400)), (2000, (8, 12, 40))])
def test_recall_by_length_and_number_of_items(spark, n_items, lengths):
    """Verbatim stretches of documents as items: each document is found again."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = random.Random(n_items)
    held = [(x.doc_id, x.text.split()) for x in docs.orderBy("doc_id").collect() if len(x.text.split()) >= 420]
    rows, of = [], {}
    for i in range(n_items):
        doc, words = held[r.randrange(len(held))]
        n = lengths[i % len(lengths)]
        at = r.randrange(len(words) - n)
        rows.append((i, " ".join(words[at:at + n])))
        of[i] = doc, n
    got = pairs(docs, items(spark, rows))
    for n in lengths:
        mine = [i for i in of if of[i][1] == n]
        assert sum((of[i][0], i) in got for i in mine) >= 0.98 * len(mine), n


def test_lcs_is_exact():
    r = random.Random(5)
    for _ in range(100):
        a, b = ([r.randrange(5) for _ in range(r.randrange(1, 20))] for _ in "ab")
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert D.lcs_length(D.masks(a), len(a), b) == t[-1][-1]


def test_odd_rows(spark, odd, no_docs):
    bench = items(spark, [(1, None), (2, ""), (3, "..."), (4, prose(6, 80)), (4, prose(6, 80)), (None, "no id")])
    got = sorted((r.doc_id, r.item_id) for r in D.leaks(odd, bench).collect())
    assert got == [(6, 4), (6, 4), (7, 4), (7, 4), (7, 4), (7, 4)]
    assert D.leaks(no_docs, bench).count() == 0 and D.leaks(odd, items(spark, [])).count() == 0
