"""Connected components of a table of links, in rounds of joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved_few


def component_roots(links: DataFrame) -> DataFrame:
    """(v, root) for each vertex of ``links`` (u, v) that is not its component's least vertex.

    A round sends every vertex's larger neighbours to the least vertex near it, then
    its smaller ones, till all links lead straight to a root. A hot vertex costs
    partial minima and a join that Spark can split.
    """
    e = saved_few(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        # large star: the larger neighbours of a vertex go to the least vertex near it
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        # small star: the smaller neighbours too; changed tells whether a vertex still had several
        least = e.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x"))
        small = e.join(least, "u")
        e = small.select("u", F.col("m").alias("v"), (F.col("m") != F.col("x")).alias("more")).union(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("more")))
        e = saved_few(e.groupBy("u", "v").agg(F.max("more").alias("more")), "links")
        more = not e.filter("more").isEmpty()
        e = e.select("u", "v")
        if not more and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
