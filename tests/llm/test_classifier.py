from __future__ import annotations

import zlib

import numpy as np

from burnlens.llm import classifier as K


def test_held_out_accuracy_and_contract(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = K.classify(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    label = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, label[r.doc_id]) for r in out if r.held_out and r.doc_id in label]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) >= 0.95


def test_labels_of_the_held_out_fold_change_nothing(spark, data):
    docs, labels = data("documents"), data("labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in K.classify(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark, odd, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 0), (4, None, 0), (77, 0, 1)], "doc_id long, quality int, toxic int")
    out = K.classify(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 7}) == 1
    assert K.classify(no_docs, labels).count() == 0
    assert {r.score for r in K.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_pairs_learn_an_interaction():
    r = np.random.default_rng(0)
    x = np.zeros((3000, len(K.FEATURES)))
    x[:, :2] = r.random((3000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = K.AdditiveModel.fit(x[:2000], y[:2000])
    assert (0, 1) in m.pairs and np.mean((m.score(x[2000:]) > 0.5) == y[2000:]) > 0.9
