"""Exact quotas and stratified removal by a seeded order of row ids.

A row's place in the order is a hash of seed and id, so the same rows are chosen on every run and on
any cluster. Which rows a quota takes is decided by a threshold on that hash, found from per-bucket
counts, and only the bucket on the edge is ranked: no stratum is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.functions.numbers import quota, ratio_pair, removal_plan


def scenario_mode(scenario: Column) -> Column:
    s = F.coalesce(scenario, F.lit(""))
    return F.when(F.contains(s, F.lit("no_tool")), "no_tools").when(F.contains(s, F.lit("irrelevant_tool")), "irrelevant_tools")


def seeded_rank(rows: DataFrame, key: str, seed: int, by: list[str] | None = None, buckets: int = 4096, name: str = "rank") -> DataFrame:
    """``rows`` with a rank from 0 within ``by``, in the order of the seeded hash of ``key``."""
    by = by or []
    h = F.xxhash64(F.lit(seed), F.col(key))
    marked = rows.withColumns({"__h": h, "__b": F.pmod(F.shiftrightunsigned(h, 32), F.lit(buckets))})
    counts = marked.groupBy(*by, "__b").agg(F.count("*").alias("__n"))  # at most buckets rows a stratum
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*by, "__b", before.alias("__before"))
    own = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("__h", key)) - 1
    ranked = marked.withColumn("__own", own).join(F.broadcast(counts) if not by else counts, [*by, "__b"])
    return ranked.withColumn(name, F.col("__own") + F.col("__before")).drop("__h", "__b", "__own", "__before")


def assign_controls(rows: DataFrame, key: str, no_tool_ratio=0.3, irrelevant_tool_ratio=0.1, tool_failure_ratio=0.1, seed: int = 42, scenario: str = "scenario") -> DataFrame:
    """``rows`` with tool_sampling_mode and tool_failure_enabled, in exact quotas of all rows.

    Modes that scenarios ask for count first; the rest of each quota is drawn from the other rows. Failures
    are drawn from rows that expose tools, up to their share of all rows.
    """
    marked = rows.withColumn("__asked", scenario_mode(F.col(scenario)))
    n = marked.agg(F.count("*").alias("n"), F.count_if(F.col("__asked") == "no_tools").alias("a"), F.count_if(F.col("__asked") == "irrelevant_tools").alias("b")).first()
    first, second = ratio_pair(no_tool_ratio, irrelevant_tool_ratio)
    open_ = n["n"] - n["a"] - n["b"]
    none = min(max(0, quota(n["n"], first) - n["a"]), open_)
    other = min(max(0, quota(n["n"], second) - n["b"]), open_ - none)
    ranked = seeded_rank(marked.withColumn("__free", F.col("__asked").isNull()), key, seed, ["__free"], name="__r")
    drawn = F.when(F.col("__r") < none, "no_tools").when(F.col("__r") < none + other, "irrelevant_tools").otherwise("normal")
    moded = ranked.withColumn("tool_sampling_mode", F.coalesce("__asked", drawn)).drop("__asked", "__free", "__r")
    candidates = n["n"] - n["a"] - none
    failing = min(candidates, quota(n["n"], tool_failure_ratio))
    again = seeded_rank(moded.withColumn("__can", F.col("tool_sampling_mode") != "no_tools"), key, seed + 1, ["__can"], name="__r")
    return again.withColumn("tool_failure_enabled", F.col("__can") & (F.col("__r") < failing)).drop("__can", "__r")


def effective_mode(mode: Column) -> Column:
    return F.when(mode.isin("no_tools", "irrelevant_tools", "normal"), mode).otherwise("normal")


def downsample(rows: DataFrame, key: str, target_intent: str, remove_count: int, intent: str = "intent", mode: str = "mode", no_tool_ratio=0.3, irrelevant_tool_ratio=0.1, seed: int = 42) -> DataFrame:
    """``rows`` with ``removed``: ``remove_count`` rows of one intent, shared over the modes by largest remainder."""
    marked = rows.withColumns({"__t": F.coalesce(F.col(intent) == target_intent, F.lit(False)), "__m": effective_mode(F.coalesce(F.col(mode), F.lit("")))})
    sizes = {r["__m"]: r["count"] for r in marked.where("__t").groupBy("__m").count().collect()}  # three rows
    if remove_count <= 0:
        return marked.withColumn("removed", F.lit(False)).drop("__t", "__m")
    if remove_count >= sum(sizes.values()):
        raise ValueError(f"cannot remove {remove_count} of {sum(sizes.values())} rows of {target_intent}")
    goes = removal_plan(sizes, remove_count, no_tool_ratio, irrelevant_tool_ratio)
    ranked = seeded_rank(marked, key, seed, ["__t", "__m"], name="__r")
    most = F.coalesce(*(F.when(F.col("__m") == m, n) for m, n in goes.items()), F.lit(0))
    return ranked.withColumn("removed", F.col("__t") & (F.col("__r") < most)).drop("__t", "__m", "__r")


def weighted_choice(key: Column, weights: dict[str, float], seed: int) -> Column:
    """A seeded choice per key with the given weights."""
    x = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1_000_000
    total, upto, out = sum(weights.values()), 0.0, None
    for name, w in weights.items():
        upto += w / total
        out = F.when(x < upto, name) if out is None else out.when(x < upto, name)
    return out.otherwise(list(weights)[-1])


def seeded_subset(items: Column, count: Column, key: Column, seed: int) -> Column:
    """``count`` elements of an array in a seeded order of its own for each key."""
    ordered = F.array_sort(F.transform(items, lambda x: F.struct(F.xxhash64(F.lit(seed), key, x).alias("h"), x.alias("x"))))
    return F.slice(F.transform(ordered, lambda s: s["x"]), F.lit(1), F.greatest(count, F.lit(0)).cast("int"))
