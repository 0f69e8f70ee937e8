"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on rows (u, v) with u > v."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), "cc-min")
        linked = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = cut(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return linked.where("u > v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that is not the smallest of its component.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until
    the links form stars around the smallest ids. Links with a null end and
    self links say nothing; ids without links do not appear.
    """
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where("u > v").distinct(), "cc")
    state = None
    while True:
        summary = edges.agg(F.count(F.lit(1)).alias("n"),
                            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if summary.n == 0 or summary == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = summary
        edges = cut(_star(cut(_star(edges, True), "cc"), False), "cc")
