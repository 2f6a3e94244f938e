"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet, never by a local checkpoint: a written table survives the
loss of any executor, and its real size is known to adaptive execution when it is read again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Paths of the tables that are still there, in the order of their writing.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where none is set, a temporary folder if the session is local, as in
    tests; on a cluster that is an error, as executors elsewhere could not read it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="siltmill-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/siltmill-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _WRITTEN.append(path)
    read = spark.read.schema(df.schema).parquet(path)
    read.scratch_path = path
    return read


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` wrote and nobody reads any more."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            delete(df.sparkSession, path)


def written() -> list[str]:
    """The tables that are there now."""
    return list(_WRITTEN)


def discard_all(spark: SparkSession, paths: list[str]) -> None:
    """Delete those of ``paths`` that are still there, once every result that reads one is written."""
    for path in paths:
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
