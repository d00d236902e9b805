from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from burnlens.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int, part string, mask string"


def fails(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t])
        out.append((i, s or "", "".join(f for f, x in zip("ABCDE", tests) if x)))
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    found = fails(rows)
    out = {}
    for part in {p for _, p, _ in found}:
        mine = [(i, f) for i, p, f in found if p == part]
        for o in permutations("ABCDE"):
            left = mine
            for k, x in enumerate(o):
                hit = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                out[part, "".join(o), k + 1] = [len(left), len(hit), sum(x in f for _, f in mine) - len(hit), sum(f == x for _, f in mine),
                                                sum(i in good for i, _ in hit), sum(i in toxic for i, _ in hit)]
    shapley = Counter()
    for (part, o, k), v in out.items():
        shapley[part, o[k - 1]] += v[1]
    return sorted((*key, *v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items())


def result(df):
    cols = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return sorted(tuple(r) for r in df.select(cols).collect())


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "xx", s, 1, "m", 2, True) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, maybe boolean")
    return docs, spark.createDataFrame([(*r, "p", "q") for r in labels], LABELS)


def test_against_plain_python(spark, data):
    docs, labels = data("documents"), data("labels")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    told = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    assert result(A.interactions(docs, labels)) == expected(rows, told)


ROWS = [(5, None, "a"), (4, "", "a"), (9, "", None), (9, "x", ""), (7, "SHOUT # é", "b"), (7, "SHOUT # é", "b"), (8, "SHOUT # é", "c"),
        (None, "", "a"), (None, "x", None), (3, "w " * 30_000, "d"), (2, " ".join(f"w{i}" for i in range(20_000)), "d"), (11, "\t\n \x0b", "d"),
        (12, "one two \U0001f600 |", "e"), (1, "x", "f"), (20, "w " * 30_000, "d"), (21, "É" * 300, "e")]
TOLD = [(5, 1, 0), (5, 0, 1), (7, 1, 1), (None, 1, 1), (9, None, 1), (20, 1, 0), (404, 1, 1)]


def test_odd_rows(spark):
    docs, labels = frames(spark, ROWS, TOLD)
    assert result(A.interactions(docs, labels)) == expected(ROWS, TOLD)
    assert result(A.interactions(docs.repartition(9), labels)) == expected(ROWS, TOLD)
    assert result(A.interactions(docs, labels.where("false"))) == expected(ROWS, [])
    assert result(A.interactions(docs.where("false"), labels)) == []


@pytest.mark.parametrize("size", [4, 64, 1 << 16])
def test_flags_dont_depend_on_the_sketch(spark, size):
    """Four counters make every text a possible repeat."""
    rows = ROWS + [(100 + i, f"text {i % 40}", "z") for i in range(200)]
    docs, _ = frames(spark, rows, [])
    bits = {sum(1 << "ABCDE".index(x) for x in f): f for f in {f for _, _, f in fails(rows)}}
    got = sorted(((r.doc_id, r.part, bits.get(r["mask"])) for r in A.flags(docs, size).collect()), key=str)
    assert got == sorted(fails(rows), key=str)


def test_sketch_clears_only_unique_texts_and_merges(spark):
    r = np.random.default_rng(3)
    once, often = r.integers(-2**63, 2**63 - 1, 3000), r.integers(-2**63, 2**63 - 1, 500)
    hashes = np.concatenate([once, often, often, often[:7].repeat(300)])
    df = spark.createDataFrame([(int(h),) for h in r.permutation(hashes)], "h long")
    size = A.sketch_size(len(hashes))
    one, many = A.merged(df.coalesce(1), size), A.merged(df.repartition(13), size)
    assert (one == many).all()
    assert A.maybe_repeated(one, often).all()
    assert A.maybe_repeated(one, once).mean() < 0.05  # 16 counters a row
    assert A.sketch_size(10**12) == A.MAX_COUNTERS


def test_masks_of_chunks():
    texts = ["", "a b a", "A", "#", " x "]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0] + [len(t) for t in raw])
    assert A.masks(np.frombuffer(b"".join(raw), np.uint8), off).tolist() == [1, 1, 5, 9, 1]
