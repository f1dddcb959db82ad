"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import write_shared


def _stars(pairs: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its least neighbour.

    Only minima are aggregated, so a node with very many neighbours costs one
    partially aggregated row, never a gathered list.
    """
    both = pairs.select(F.col("u").alias("n"), F.col("v").alias("m"))
    if large:
        both = both.unionByName(pairs.select(F.col("v").alias("n"), F.col("u").alias("m")))
    else:
        both = both.select(F.greatest("n", "m").alias("n"), F.least("n", "m").alias("m"))
    least = both.groupBy("n").agg(F.min("m").alias("low")).withColumn("low", F.least("n", "low"))
    linked = both.join(least, "n")
    if large:
        out = linked.where("m > n").select(F.col("m").alias("u"), F.col("low").alias("v"))
    else:
        out = linked.select(F.col("m").alias("u"), F.col("low").alias("v")).unionByName(
            least.select(F.col("n").alias("u"), F.col("low").alias("v"))
        )
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 40) -> DataFrame:
    """node, component (its smallest node) of every node in a proper edge.

    Null ends and loops are ignored; repeated edges don't matter; an empty
    table gives an empty result. Each round is written to the shared folder,
    so the plan stays short and a lost executor costs one round. Raises if
    max_rounds (a logarithmic number is usual) isn't enough.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    pairs = write_shared(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        pairs = write_shared(_stars(_stars(pairs, True), False), "cc")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
