"""Exact per-key totals and quantiles when a few keys hold most of the rows.

A key's values are never gathered. Rows are first reduced to counts of
(key, value bin) with map-side combining; the bin that holds each wanted rank
is split again and again until it is one value. A hot key costs no more than
`bins` small rows for each task and round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_shared

#: A key is hot from this share (one HOT-th) of all rows on.
HOT = 2_000


def key_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, total, low, high: n counts rows with a value, total sums them.

    Sums and counts are combined before the shuffle, so a hot key adds one row
    for each task. Null keys form a key of their own; null values don't count.
    """
    v = F.col(value)
    return df.groupBy(F.col(key).alias("key")).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high")
    )


def key_quantiles(
    df: DataFrame, key: str, value: str, quantiles: list[float | Callable[[Column], Column]], bins: int = 64, totals: DataFrame | None = None
) -> DataFrame:
    """key, n, total, low, high and array q: the exact quantiles (the value of
    rank ceil(q*n), ranks from 1) of a whole-number column for each key. A
    quantile may also be a function from n to a rank.

    Refines histograms: each round counts, for every (key, open quantile), the
    values of `bins` equal parts of the range that still holds the rank, and
    keeps the part with the rank. The range shrinks bins-fold a round, so 64
    bits need at most 11 rounds. Keys with no value get null quantiles. An
    empty table gives an empty result. Extra columns don't matter.

    A key with more than a HOT-th of all rows is hot; there are fewer than HOT
    of them, so their ranges are broadcast and their rows stay where they are.
    The rows of other keys meet theirs by a shuffle.
    """
    rows = df.select(F.col(key).alias("key"), F.col(value).cast("long").alias("v"))
    totals = write_shared(totals if totals is not None else key_totals(rows, "key", "v"), "hk-totals")
    whole = totals.agg(F.sum("n")).first()[0] or 0
    hot = totals.where(F.col("key").isNotNull() & (F.col("n") * HOT > F.lit(whole))).select(F.col("key").alias("hot"))
    rows = rows.where("v is not null").join(F.broadcast(hot), F.col("key") == F.col("hot"), "left")
    rows = write_shared(rows.select("key", "v", F.col("hot").isNotNull().alias("is_hot")), "hk-rows")
    ranks = [q(F.col("n")) if callable(q) else F.ceil(F.col("n") * F.lit(float(q))) for q in quantiles]
    ranks = [F.greatest(F.lit(1).cast("long"), r.cast("long")) for r in ranks]
    open_ = totals.where("n > 0").select("key", F.posexplode(F.array(*ranks)).alias("i", "rank"), F.col("low").cast("long").alias("lo"), F.col("high").cast("long").alias("hi"))
    open_ = write_shared(open_.select("key", "i", "lo", "hi", "rank"), "hk-open")
    done = None
    while True:
        closed = open_.where("lo = hi").select("key", "i", F.col("lo").alias("x"))
        done = closed if done is None else done.unionByName(closed)
        live = open_.where("lo < hi").withColumn("w", _width(F.col("lo"), F.col("hi"), bins))
        if live.isEmpty():
            break
        # The open ranges of a key travel together as one short array (one
        # entry for each quantile), so a row meets its key's ranges at once.
        ranges = live.groupBy("key").agg(F.collect_list(F.struct("i", "lo", "hi", "w")).alias("rs")).withColumnRenamed("key", "k")
        few = ranges.join(F.broadcast(hot), F.col("k") == F.col("hot"), "left_semi")
        met = rows.where("is_hot").join(F.broadcast(few), F.col("key") == F.col("k")).unionByName(
            rows.where("not is_hot").join(ranges.join(F.broadcast(hot), F.col("k") == F.col("hot"), "left_anti"), F.col("key").eqNullSafe(F.col("k")))
        )
        hit = (
            met.select("key", "v", F.explode("rs").alias("r"))
            .where("v between r.lo and r.hi")
            .groupBy("key", F.col("r.i").alias("i"), F.expr("(v - r.lo) div r.w").alias("b"))
            .agg(F.count("*").alias("c"))
        )
        # At most `bins` counts for each open quantile, whatever the key holds.
        hist = hit.groupBy("key", "i").agg(F.array_sort(F.collect_list(F.struct("b", "c"))).alias("h"))
        found = live.alias("o").join(
            hist.alias("g"), F.col("o.key").eqNullSafe(F.col("g.key")) & (F.col("o.i") == F.col("g.i"))
        ).select("o.*", "h")
        # Walk the counts: the part in which the running count reaches rank.
        walk = F.expr(
            "aggregate(h, named_struct('left', rank, 'b', cast(null as bigint)), (s, x) -> "
            "if(s.b is not null, s, if(x.c >= s.left, named_struct('left', s.left, 'b', x.b), named_struct('left', s.left - x.c, 'b', s.b))))"
        )
        found = found.withColumn("s", walk)
        open_ = write_shared(
            found.select(
                "key", "i",
                F.expr("lo + s.b * w").alias("nlo"), F.expr("least(hi, lo + s.b * w + w - 1)").alias("hi"),
                F.col("s.left").alias("rank"),
            ).withColumnRenamed("nlo", "lo").select("key", "i", "lo", "hi", "rank"),
            "hk-open",
        )
    qs = done.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("q"))
    return totals.alias("t").join(qs.alias("q"), F.col("t.key").eqNullSafe(F.col("q.key")), "left").select("t.*", F.col("q.q").alias("q"))


def _width(lo: Column, hi: Column, bins: int) -> Column:
    """Width of a part so that `bins` parts cover lo..hi (at least 1)."""
    return F.greatest(F.lit(1).cast("long"), F.floor((hi - lo) / bins).cast("long") + 1)
