"""Connected components by alternating star contractions (Kiveris et al. 2014), one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = both.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of the component, for every node of ``edges`` (a, b: long) but the roots."""
    now = save(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, before = mark, now
        now = save(_star(_star(now, True), False), "edges")
        drop(before)
