"""Folds, best rows, runs and row numbers over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_shared


def latest_by_key(df: DataFrame, key: str, order: Column, carry: list[str], coalesced: list[str] = ()) -> DataFrame:
    """key, attempts, the carried columns of the last row, and for coalesced
    columns the last value that isn't null. One partially aggregated pass; a
    hot key sends one row for each task. order must be unique in a key."""
    last = F.max_by(F.struct(*carry), order).alias("__last")
    kept = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in coalesced]
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("attempts"), last, *kept)
    return out.select(key, "attempts", "__last.*", *coalesced)


def best_by_key(df: DataFrame, keys: list[str], quality: list[Column], ordinal: Column) -> DataFrame:
    """The best row of each key: highest quality, then least ordinal. The plan
    keeps one row for each key and task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*[q.desc_nulls_last() for q in quality], ordinal.asc())
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_by_key(df: DataFrame, keys: list[str], ordinal: Column) -> DataFrame:
    return best_by_key(df, keys, [], ordinal)


#: Shares that a hot key's rows are dealt to when they meet its one row.
SALTS = 16


def numbered(df: DataFrame, order: list[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """df with a global row number from 0 in the given order (columns by name
    ascend, nulls last).

    One range shuffle: partitions are sorted and written with the place of
    each row, and a partition's rows go after those of the partitions before.
    No single partition holds the table; only one count for each partition is
    broadcast. The order must be total, or equal rows are numbered in any
    order. A column called name must not exist. An empty table stays empty.
    """
    if name in df.columns:
        raise ValueError(f"{name} exists")
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    # Partition number in the upper bits, place within it in the lower 33.
    ranged = write_shared(ranged.withColumn("__m", F.monotonically_increasing_id()), "numbered")
    ranged = ranged.withColumn("__p", F.shiftright("__m", 33))
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    offsets = counts.select("__p", F.coalesce(before, F.lit(0)).alias("__o"))
    return ranged.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__o") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__p", "__o", "__m")


def ranked(df: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """df with the row number (from 1) within each key, in the given order:
    its global number after its key's first. A hot key lies in many range
    partitions, so no task holds it; the key's first number is met salted, by
    shuffle: many keys are small compressed, but not as the driver's broadcast.
    Null keys are keys of their own. A column called name must not exist."""
    if name in df.columns:
        raise ValueError(f"{name} exists")
    rows = numbered(df, [*keys, *order], "__no")
    first = rows.groupBy(*keys).agg(F.min("__no").alias("__first"))
    names = [f"__k{i}" for i in range(len(keys))]
    first = first.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt2"))
    rows = rows.withColumn("__salt", F.pmod(F.col("__no"), F.lit(SALTS)).cast("int"))
    same = F.col("__salt") == F.col("__salt2")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return rows.join(first.hint("merge"), same).withColumn(name, F.col("__no") - F.col("__first") + 1).drop(*names, "__no", "__first", "__salt", "__salt2")


def listed(df: DataFrame, keys: list[str], order: list[str | Column], value: Column, size: int, name: str) -> DataFrame:
    """keys, part (from 0), name: the values of each key as arrays of at most
    `size`, in order. A hot key gives many arrays, never one. Null keys are keys
    of their own, null values stay in their place; no key may be called part
    or name."""
    if {"part", name} & set(keys):
        raise ValueError(f"a key is called part or {name}")
    rows = ranked(df.withColumn("__v", value), keys, order, "__n").select(*keys, "__n", "__v", F.floor((F.col("__n") - 1) / size).cast("int").alias("part"))
    got = rows.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("__n", F.col("__v").alias("v")))).alias("__l"))
    return got.select(*keys, "part", F.transform("__l", lambda x: x["v"]).alias(name))


def runs(df: DataFrame, value: str, position: str, within: list[str]) -> DataFrame:
    """Runs of equal values in position order: within, value, start, length.

    Gaps and islands in each `within` group (a file, say), so groups run in
    parallel. Nulls equal each other."""
    w = Window.partitionBy(*within).orderBy(position)
    fresh = F.when(F.lag(F.struct(value)).over(w).eqNullSafe(F.struct(value)), 0).otherwise(1)
    marked = df.select(*within, value, position, fresh.alias("__f"))
    marked = marked.withColumn("__i", F.sum("__f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*within, value, "__i").agg(F.min(position).alias("start"), F.count("*").alias("length")).drop("__i")


def inversions(df: DataFrame, value: Column, position: str, within: list[str]) -> DataFrame:
    """rows and inversions (a value below the one before it) of each group."""
    w = Window.partitionBy(*within).orderBy(position)
    return (
        df.select(*within, position, value.alias("__v"))
        .withColumn("__b", F.lag("__v").over(w))
        .groupBy(*within)
        .agg(F.count("*").alias("rows"), F.count_if(F.col("__b") > F.col("__v")).alias("inversions"))
    )


def priority_union(tiers: list[DataFrame], key: str) -> DataFrame:
    """Rows of the first tier that has the key, with a column tier from 0."""
    tagged = [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    first = every.groupBy(key).agg(F.min("tier").alias("tier"))
    return every.join(first, [key, "tier"])
