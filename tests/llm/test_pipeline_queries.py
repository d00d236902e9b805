from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as C
from burnlens.llm import decontamination, ngram_join
from burnlens.llm.common import materialise, table

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op3": "doc_id piece start length ids_crc32 sequence_id offset", "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5": "page_id url text n_chars", "op6": "doc_id n_shingles component_id", "op8": "doc_id held_out score predicted",
    "op9": "page_id payload_bytes payload_digest record_type refers_to",
    "op11": "vec_id code error label_error codebooks_sha256", "op13": "doc_id size source_size target taken",
    "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


def test_every_query_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(m[1]) for k in names if (m := re.match(r"op(\d+)_", k))) == list(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_contract_columns(spark, op):
    name = next(k for k in entry.queries() if k.startswith(op + "_"))
    assert set(COLUMNS[op].split()) <= set(entry.queries()[name](spark, SF).columns)


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_sql_twins(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    twin = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in twin.description]
    want = sorted((tuple(r) for r in twin.fetchall()), key=str)
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted((tuple(r) for r in df.select(cols).collect()), key=str) == want


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    for name, stage in C.STAGES[:-1]:
        out = materialise(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
        assert set(after) <= set(before)
        if name == "quality_classifier":
            told = [(i in after, quality[i] == 1) for i in before if i in quality]
            assert sum(a == b for a, b in told) >= 0.95 * len(told)
        if name == "line_dedup":
            assert all(set(after[i].split("\n")) <= set(before[i].split("\n")) for i in after)
            assert out.where(F.length("text") != F.col("n_chars")).join(docs.select("doc_id", F.col("text").alias("was")), "doc_id").where("text != was").count() == 0
        if name == "ngram_jaccard_join":
            groups = {r.doc_id: r.component_id for r in ngram_join.join(docs, percent=80, words=5).collect()}
            assert set(after) == set(groups.values())
        if name == "benchmark_decontamination":
            leaks = {r.doc_id for r in decontamination.leaks(docs, table(spark, SF, "benchmark")).collect()}
            assert set(after) == set(before) - leaks
        docs = out
    assert C.run(spark, SF).groupBy("doc_id").agg(F.count("*")).count() == docs.count()


def test_odd_rows_pass_the_stages(spark, odd, no_docs):
    for docs in (odd, no_docs):
        for name, stage in C.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF), name)
            assert docs.columns == odd.columns
        C.STAGES[-1][1](spark, docs, SF).count()
