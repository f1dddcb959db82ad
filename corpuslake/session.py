"""Session factory and the shared folder that long plans are cut at."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "corpuslake", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only in local mode, and where none is named, a folder of this machine is
    set, once for each session, and deleted at the end of the process. On a
    cluster without a named folder this raises: each executor would write to a
    disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="corpuslake-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        named = "file://" + local
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in the application's own part."""
    return os.path.join(shared_dir(spark), f"corpuslake-{spark.sparkContext.applicationId}", f"{name}-{uuid.uuid4().hex}")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there.

    Columnar and compressed, so it is smaller than checkpoint(), and later
    reads prune columns. Survives the loss of any executor.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Delete all that this application wrote with write_shared. To be called
    when the results of its queries have been read or written elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(shared_dir(spark), f"corpuslake-{spark.sparkContext.applicationId}"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
