"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        e = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        m = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return e.join(m, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    m = e.groupBy("a").agg(F.min("b").alias("m"))
    return e.join(m, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(m.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id with an edge but the roots themselves; root is the component's smallest id.

    edges has a and b, both long; loops and repeats do no harm. A vertex with very many edges is read in
    pre-aggregated minima, never as one group; each step ends in a written table."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        seen = mark
        now = materialize(_star(_star(now, True), False), "edges")
