"""Writers: Parquet, files by key, JSON lines, key indexes, small manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def parquet(
    df: DataFrame, path: str, codec: str = "zstd", sort: list[str] | None = None, mode: str = "overwrite", rows: int | None = None, group_bytes: int | None = None
) -> None:
    """Parquet, range-partitioned and sorted where asked, so that row-group
    statistics let later reads skip. rows: most of a file; group_bytes: most
    of a row group, about."""
    if sort:
        keys = [F.col(c).asc_nulls_last() for c in sort]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.write.mode(mode).option("compression", codec)
    w = w.option("maxRecordsPerFile", rows) if rows else w
    (w.option("parquet.block.size", group_bytes) if group_bytes else w).parquet(path)


def by_key(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """One folder for each value of key; the combined table is the same path."""
    df.write.mode(mode).partitionBy(key).option("compression", "zstd").parquet(path)


def jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def index(df: DataFrame, path: str, columns: list[str]) -> None:
    """A narrow side index of the key columns."""
    parquet(df.select(*columns), path, sort=columns[:1])


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, quotes doubled, blanks at the ends kept."""
    df.write.mode(mode).option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def text(df: DataFrame, path: str, codec: str = "none", mode: str = "overwrite") -> None:
    """Lines of a table with one string column."""
    df.write.mode(mode).option("compression", codec).text(path)


def graph(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with their keys in order."""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bytes_file(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file on the file system of its path, replaced."""
    p, fs = _file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(data))
    out.hflush()
    out.close()


def manifest(spark: SparkSession, values: dict, path: str) -> None:
    """A small JSON file with sorted keys on any file system Spark writes to,
    written beside its place and renamed, so readers see the old or the new."""
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    bytes_file(spark, draft, json.dumps(values, sort_keys=True, indent=1).encode())
    p, fs = _file_system(spark, path)
    fs.delete(p, False)
    if not fs.rename(_file_system(spark, draft)[0], p):
        raise OSError(f"{path} could not be replaced")
