"""JSON-lines sinks: overwrite, append, split in two, and replacement of what is being read."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.scratch import new_path


def as_lines(df: DataFrame) -> DataFrame:
    """A column ``value`` of JSON with null fields kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    as_lines(df).write.mode(mode).text(path)


def append(df: DataFrame, path: str) -> None:
    write(df, path, "append")


def split(df: DataFrame, flag: str, true_path: str, false_path: str) -> None:
    """Both sides of a boolean column; null counts as false."""
    yes = F.coalesce(F.col(flag), F.lit(False))
    write(df.where(yes).drop(flag), true_path)
    write(df.where(~yes).drop(flag), false_path)


def replace(df: DataFrame, path: str, backup: bool = True, raw: bool = False) -> str | None:
    """Writes next to ``path``, then renames: safe for a ``df`` that reads ``path``. Returns the backup's path.
    ``raw`` takes ``df`` as lines and not as rows to be made JSON."""
    spark: SparkSession = df.sparkSession
    fresh = new_path(spark, "replace")
    (df if raw else as_lines(df)).write.text(fresh)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(fresh)
    fs = target.getFileSystem(conf)
    kept = f"{path}.bak_{time.strftime('%Y%m%d_%H%M%S')}" if backup and fs.exists(target) else None
    if kept:
        fs.rename(target, jvm.org.apache.hadoop.fs.Path(kept))
    else:
        fs.delete(target, True)
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, target, True, conf):
        raise OSError(f"could not move {fresh} to {path}")
    return kept


def prune_log(log: DataFrame, order: str, keep: int = 200) -> DataFrame:
    """The last ``keep`` records of an append-only log."""
    return log.orderBy(F.col(order).desc()).limit(keep)
