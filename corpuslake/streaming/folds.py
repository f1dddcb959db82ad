"""Streams of new files into keyed tables, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_path


def file_stream(spark: SparkSession, path: str, schema, pattern: str = "*", per_trigger: int | None = None, kind: str = "parquet") -> DataFrame:
    """New files of a folder, each exactly once by the query's checkpoint."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.format(kind).load(path)


def run_available(df: DataFrame, each, mode: str = "append", ledger: str | None = None) -> None:
    """Process what there is in micro-batches and stop. each(batch, number)
    must give the same result if a batch is repeated after a failure. With a
    ledger (a folder kept between runs) only what came since is processed."""
    place = ledger or shared_path(df.sparkSession, "stream")
    df.writeStream.outputMode(mode).option("checkpointLocation", place).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def fold_latest(stream: DataFrame, key: str, order: Column, carry: list[str], place: str | None = None) -> DataFrame:
    """Latest row and number of rows of each key after all micro-batches; with
    a place, of all runs so far that named it.

    Each batch writes its own partial fold under its number (a repeat writes
    the same files again); reading folds the partials, so no table is ever
    rewritten and state doesn't grow in memory."""
    spark = stream.sparkSession
    place = place or shared_path(spark, "fold")
    out = f"{place}/parts"

    def each(batch: DataFrame, number: int) -> None:
        part = batch.groupBy(key).agg(F.max(F.struct(order.alias("o"), *carry)).alias("last"), F.count("*").alias("n"))
        part.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_available(stream, each, ledger=f"{place}/ledger")
    return spark.read.parquet(out).groupBy(key).agg(F.max("last").alias("last"), F.sum("n").alias("n")).select(key, "last.*", "n").drop("o")


def windowed_counts(stream: DataFrame, time: str, by: str, window: Column, late: str = "1 hour", append: bool = True) -> DataFrame:
    """n and total of each window and value of by; rows later than the
    watermark are dropped once their window is closed."""
    return stream.withWatermark(time, late).groupBy(window.alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def to_table(stream: DataFrame, mode: str) -> DataFrame:
    """All output of a stream (complete: the last) as a table."""
    spark = stream.sparkSession
    out = shared_path(spark, "out")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    run_available(stream, each, mode)
    return spark.read.option("basePath", out).parquet(out).select(*stream.columns)
