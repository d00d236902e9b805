"""Connected components of links between documents, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a > b)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u")
    if large:  # larger neighbours go to the least of the neighbourhood
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # the node and its smaller neighbours do
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the least id reachable.

    Large-star and small-star steps alternate until the edges are stars; each
    step is a few joins and a table in the shared folder, and the number of
    steps grows with the logarithm of the longest chain. A node with very many
    links is met by a partial aggregate and by a join that Spark splits."""
    edges = materialise(
        links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .where(F.col("a") != F.col("b")).distinct(), "links")
    before = _summary(edges)
    while before[0]:
        edges = materialise(_star(_star(edges, True), False), "links")
        now = _summary(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
