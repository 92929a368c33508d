"""Connected components of an edge table (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Every node's smallest neighbour is found by a partial
    aggregation; the join back is an equi-join that AQE splits if skewed."""
    e = edges if not large else edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = e.join(low, "u")
    if large:
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # edges point down (u > v): hang v and u below the smallest
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from every id on an edge.

    Runs until the edge set is a set of stars; the number of rounds grows
    with the logarithm of the longest path, each round's edges are written
    to the shared folder, and no edge or label reaches the driver.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = keep(spark, e, "edges")
    seen = None
    while True:
        n, s, bad = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)),
                          F.count("*") - F.count_distinct("u")).first()
        # stars: every u has one edge and no v is itself a u
        if n == 0 or (bad == 0 and (n, s) == seen):
            break
        seen = (n, s)
        e = keep(spark, _star(_star(e, True), False), "edges")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)
