"""Durable intermediate tables in the folder that all executors see."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or an own one where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm.get() if jvm.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="skysift-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for this process's own files; it is removed when the driver process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    The tables are removed when the driver process ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, f"tables/{name}")
    # the shuffles of a written table are of no more use: let Spark drop their files when it is written
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _forget() -> None:
    for spark, path in _written:
        try:
            jvm = spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may have gone already
            return


atexit.register(_forget)
