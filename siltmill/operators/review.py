"""Review protocol: score gate and the three-way split of merged rows by their reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.text import first_truthy


def gate(decision: Column, score: Column, min_pass_score: int = 3) -> Column:
    """A pass with too low a score is a reject."""
    if not 1 <= min_pass_score <= 5:
        raise ValueError("min_pass_score must be 1 to 5")
    return F.when((decision == "pass") & (score < min_pass_score), "reject").otherwise(decision)


def latest_reviews(reviews: DataFrame, order: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(key, decision, ...)``: the last review of each source sample, by ``order``; keyless rows are dropped."""
    source = F.col("source_id").cast("string") if "source_id" in reviews.columns else F.lit(None).cast("string")
    key = first_truthy(F.col("source_sample_id").cast("string"), source)
    named = reviews.withColumn("key", key).where("key is not null")
    last = named.groupBy("key").agg(F.max_by(F.struct("decision", *extra), F.col(order)).alias("r"))
    return last.select("key", "r.*")


def split(merged: DataFrame, reviews: DataFrame, order: str = "row_idx", merge_source: str = "merge_source") -> DataFrame:
    """``merged`` with ``outcome``: approved, rejected or unmatched (a row without a review that isn't planner_final)."""
    last = latest_reviews(reviews, order).withColumnRenamed("decision", "review_decision")
    joined = merged.join(last, merged["id"].cast("string") == last["key"], "left").drop("key")
    own = F.coalesce(F.col(merge_source), F.lit(""))
    outcome = (
        F.when(F.col("review_decision") == "pass", "approved").when(F.col("review_decision").isNotNull(), "rejected")
        .when(own == "planner_final", "approved").otherwise("unmatched")
    )
    return joined.withColumn("outcome", outcome).drop("review_decision")


def split_stats(outcomes: DataFrame, reviews: DataFrame, order: str = "row_idx") -> DataFrame:
    counts = outcomes.agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("approved", "rejected", "unmatched")))
    return latest_reviews(reviews, order).agg(F.count("*").alias("reviews")).crossJoin(counts)  # one row each
