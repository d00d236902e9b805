"""Quality rules as a short-circuit cascade (operator 4).

The base metrics of a text (words, word characters, symbols, duplicate lines,
words in repeated 3-word windows) are computed for every row. The verdict of
the rows that pass the base test comes from a cascade of rejection rules in
one CASE: a rule is evaluated only where the earlier ones let the text pass.
``estimate`` runs each rule on a bounded sample and measures its time and the
share of texts that it rejects; the rules are then ordered by rejection per
cost. The order decides how much is computed, never the verdict: a text is
kept when no rule rejects it.

DataFrame functions only; no shuffle, no Python on the executors.

Contract cases: NULL and empty texts have no words, fail the base test and are
not kept; repeated rows give a row each; an empty table gives an empty result
(the rules then keep their given order); extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"  # all else
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 1000
#: Bits of a packed (hash, position) entry that hold the position.
POSITION_BITS = 30

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition over text, words, lines and the base metrics; never NULL."""
    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    n = F.col("n_words")
    words, text = F.col("words"), F.col("text")
    share = lambda part, whole, most: part > F.lit(most) * whole
    return [
        Rule("symbols", share(F.col("n_symbols"), n, 0.1)),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 14 * n)),
        Rule("duplicate_lines", share(F.col("n_dup_lines"), F.size(F.split(text, "\n")), 0.5)),
        Rule("shouting", share(F.regexp_count(text, F.lit("[A-Z]")), F.regexp_count(text, F.lit("[A-Za-z]")) + 10, 0.3)),
        Rule("exclamation", share(F.regexp_count(text, F.lit("[!?]")), n, 0.3)),
        Rule("few_distinct_words", F.size(F.array_distinct(words)) < F.lit(0.05) * n),
        Rule("no_letters", share(F.regexp_count(text, F.lit("[0-9]")), F.length(text), 0.4)),
    ]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once: plain references in a
    lambda would be evaluated per element wherever Catalyst inlines them."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Windows are first matched by hash: each window becomes a long of hash bits
    over its position, so sorting longs brings equal hashes together. Windows
    with a hash in common are then compared as texts, so a hash collision
    changes nothing. Texts without two equal hashes (most) skip all that."""
    shift, low = POSITION_BITS, F.lit(2**POSITION_BITS - 1)
    key = lambda v: F.shiftright(v, shift)
    window = lambda w, i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(*window(w, i)))

    def same_hash(h: Column) -> Column:  # positions of windows whose hash another window has
        packed = F.sort_array(F.transform(h, lambda x, i: F.shiftleft(x, shift).bitwiseOR(i.cast("long"))))
        return _let(packed, lambda p: F.transform(
            F.filter(p, lambda v, i: (key(v) == key(F.get(p, i - 1))) | (key(v) == key(F.get(p, i + 1)))),
            lambda v: v.bitwiseAND(low).cast("int")))

    def same_text(w: Column, at: Column) -> Column:  # those whose text another window has
        texts = F.sort_array(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *window(w, i)).alias("w"), i.alias("i"))))
        return _let(texts, lambda t: F.transform(
            F.filter(t, lambda v, k: (v["w"] == F.get(t, k - 1)["w"]) | (v["w"] == F.get(t, k + 1)["w"])),
            lambda v: v["i"]))

    def covered(at: Column) -> Column:
        return F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))

    def count(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(hashes(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(same_text(w, same_hash(h)), covered))))

    return _let(words, count).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and the base metrics of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    two = one.withColumn("words", F.array_remove(F.split("text", WORD_GAP), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return two.select(
        "doc_id", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def estimate(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule over at most ``rows``
    sampled rows, held in memory so that a rule's time is its own."""
    sample = measured(docs.sample(0.05, seed=7).limit(rows)).where(~base_failed()).persist()
    try:
        n = sample.count()
        if not n:
            return [(r, 1.0, 0.0) for r in rules]

        def run(cond: Column) -> tuple[float, float]:
            job = sample.agg(F.avg(cond.cast("double")).alias("x"))
            job.collect()  # compiles
            began = time.perf_counter()
            share = job.collect()[0]["x"]
            return time.perf_counter() - began, share

        idle = run(F.col("n_words") < 0)[0]
        found = []
        for r in rules:
            took, share = run(r.rejects)
            found.append((r, max(took - idle, 1e-4), float(share or 0)))
        return found
    finally:
        sample.unpersist()


def order(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, the highest first; ties keep their order."""
    return [r for r, _, _ in sorted(estimates, key=lambda e: -e[2] / e[1])]


def cascade(rules: list[Rule]) -> Column:
    """True where no rule rejects; a rule runs only where the ones before it pass."""
    kept = F.when(base_failed(), F.lit(False))
    for r in rules:
        kept = kept.when(r.rejects, F.lit(False))
    return kept.otherwise(F.lit(True))


def apply(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, the base metrics, base_failed and kept of every row."""
    ordered = order(estimate(docs, default_rules() if rules is None else rules))
    return measured(docs).select("doc_id", *METRICS, base_failed().alias("base_failed"), cascade(ordered).alias("kept"))
