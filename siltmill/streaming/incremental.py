"""Incremental runs: new lines only, each id once, through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators.merge import resume
from siltmill.sources import jsonl, sinks


def run_available(spark: SparkSession, source: str, output: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Reads files not seen yet, transforms ``(id, raw)`` rows whose id isn't in ``output``, and appends.

    The checkpoint keeps what was read; the anti-join keeps a repeated micro-batch from writing an id
    twice, so the whole is idempotent. Rows without an id are skipped.
    """

    def batch(rows: DataFrame, _: int) -> None:
        ids = rows.select(F.get_json_object("value", "$.id").alias("id"), F.col("value").alias("raw")).where("id is not null and id <> ''")
        fresh = resume(ids.groupBy("id").agg(F.min("raw").alias("raw")), jsonl.processed_ids(spark, output))
        sinks.append(transform(fresh), output)

    stream = spark.readStream.text(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
