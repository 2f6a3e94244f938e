"""Frequencies, lengths and figures over typed columns; reports over raw JSON rows are in ``reports``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions import nested, text
from siltmill.functions.numbers import length_stats, percent
from siltmill.operators.reports import SEARCH_TOOLS

def base_stats(rows: DataFrame, ident: str = "id") -> DataFrame:
    """rows, ids, unique_ids, missing_id and duplicate_ids."""
    i = F.col(ident)
    return rows.agg(
        F.count("*").alias("rows"), F.count(i).alias("ids"), F.count_distinct(i).alias("unique_ids"),
        F.count_if(i.isNull()).alias("missing_id"), (F.count(i) - F.count_distinct(i)).alias("duplicate_ids"),
    )


def frequencies(rows: DataFrame, value: str, order: str, top: int | None = None) -> DataFrame:
    """``(value, n, first)``, most frequent first, ties by first occurrence; null counts as "(missing)"."""
    v = F.coalesce(F.col(value).cast("string"), F.lit("(missing)")).alias("value")
    out = rows.groupBy(v).agg(F.count("*").alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first")
    return out.limit(top) if top is not None else out


def shares(rows: DataFrame, value: str) -> DataFrame:
    """``(value, n, pct)`` of the total, largest first."""
    n = rows.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select("value", "n", percent(F.col("n"), F.col("total")).alias("pct")).orderBy(F.desc("n"), "value")  # one row


def lengths(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """The eight length figures, over all rows or by group. Percentiles are nearest-rank and exact."""
    return rows.groupBy(*(by or [])).agg(*length_stats(value))


def _rows_with(flag: Column, name: str, total: Column) -> list[Column]:
    n = F.count_if(F.coalesce(flag, F.lit(False)))
    return [n.alias(f"rows_with_{name}"), percent(n, total).alias(f"rows_with_{name}_pct")]


def message_stats(rows: DataFrame, messages: str = "messages", tools: str | None = None) -> DataFrame:
    """Counts over chat rows. rows_with_reasoning counts assistant messages and forbidden calls count calls,
    so these may exceed the rows."""
    m = F.col(messages)
    said = F.filter(m, lambda x: x["role"] == "assistant")
    thinks = F.size(F.filter(said, lambda x: F.contains(x["content"], F.lit("<think>")))).cast("long")
    calls = F.flatten(F.transform(said, lambda x: F.coalesce(x["tool_calls"], F.array().cast("array<struct<name:string,arguments:string>>"))))
    chars = F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + text.text_length(x["content"]))
    own = F.aggregate(said, F.lit(0).cast("long"), lambda a, x: a + text.text_length(x["content"]))
    read = rows.select(
        F.size(m).cast("long").alias("message_count"), chars.alias("chars"), own.alias("own"), thinks.alias("thinks"),
        F.exists(m, lambda x: x["role"] == "tool").alias("told"), (F.size(F.col(tools)) > 0 if tools else F.lit(False)).alias("exposed"),
        F.size(calls).cast("long").alias("calls"), F.size(F.filter(calls, lambda c: c["name"].isin(*nested.FORBIDDEN))).cast("long").alias("bad"),
    )
    n = F.count("*")
    return read.agg(
        n.alias("rows"), *_rows_with(F.col("exposed"), "exposed_tools", n), *_rows_with(F.col("told"), "tool_messages", n),
        F.sum("thinks").alias("rows_with_reasoning"), percent(F.sum("thinks"), n).alias("rows_with_reasoning_pct"),
        F.sum("bad").alias("rows_with_forbidden_tool_call"), F.sum("calls").alias("tool_calls"),
        F.struct(*length_stats("message_count")).alias("message_count"), F.struct(*length_stats("chars")).alias("message_content_chars"),
        F.struct(*length_stats("own")).alias("assistant_content_chars"),
    )


def role_counts(rows: DataFrame, messages: str = "messages") -> DataFrame:
    return rows.select(F.explode(messages).alias("m")).groupBy(F.coalesce("m.role", F.lit("")).alias("role")).agg(F.count("*").alias("n"))


def trajectory_stats(rows: DataFrame, steps: str = "steps", mode: str = "tool_sampling_mode") -> DataFrame:
    """One row of counts over trajectories. rows_with_ask and rows_with_overridden count steps."""
    s = F.col(steps)
    count = lambda test: F.size(F.filter(s, test)).cast("long")
    action = lambda x: F.coalesce(x["planner_output"]["action"], F.lit(""))
    calls = F.flatten(F.transform(s, lambda x: x["planner_output"]["tool_calls"]))
    final = F.element_at(s, -1)["planner_output"]
    blank = lambda x: (action(x) == "tool_call") & (text.strip(F.coalesce(x["planner_raw_output"]["raw_content"], F.lit(""))) == "")
    read = rows.select(
        F.size(s).cast("long").alias("steps"), count(lambda x: action(x) == "tool_call").alias("call_steps"), F.size(calls).cast("long").alias("calls"),
        F.exists(calls, lambda c: c["name"].isin(*SEARCH_TOOLS)).alias("searches"), F.exists(calls, lambda c: c["name"].isin(*nested.FORBIDDEN)).alias("forbidden"),
        nested.has_tool_error(s).alias("failed"), count(lambda x: action(x) == "ask_clarification").alias("asks"), count(lambda x: x["planner_overridden"]).alias("overridden"),
        F.exists(s, blank).alias("blank"), (F.size(s) == 0).alias("missing"), F.coalesce(final["action"] == "tool_call", F.lit(False)).alias("ends_calling"),
        F.coalesce(F.col(mode), F.lit("(missing)")).alias("mode"), text.text_length(F.col("user_query")).alias("query"),
    )
    n, special = F.count("*"), F.col("mode").isin("no_tools", "irrelevant_tools")
    steps_of = lambda c: F.coalesce(F.sum(F.when(c, F.col("steps"))), F.lit(0))
    total = F.coalesce(F.sum("steps"), F.lit(0))
    return read.agg(
        n.alias("rows"), total.alias("total_steps"), total.alias("estimated_stepwise_samples"), F.coalesce(F.sum("calls"), F.lit(0)).alias("total_tool_calls"),
        *_rows_with(F.col("calls") > 0, "tool_call", n), F.count_if("searches").alias("rows_with_search_tool_call"), F.count_if("failed").alias("rows_with_tool_error"),
        F.coalesce(F.sum("asks"), F.lit(0)).alias("rows_with_ask"), F.coalesce(F.sum("overridden"), F.lit(0)).alias("rows_with_overridden"),
        F.count_if("blank").alias("rows_with_raw_empty_tool_call"), F.count_if("forbidden").alias("rows_with_forbidden_tool_call"),
        F.count_if("missing").alias("missing_final"), F.count_if("ends_calling").alias("final_tool_call"),
        F.count_if(special).alias("special_trajectory_rows"), percent(F.count_if(special), n).alias("special_trajectory_rows_pct"),
        steps_of(special).alias("special_stepwise_samples"), percent(steps_of(special), total).alias("special_stepwise_samples_pct"),
        F.struct(*length_stats("steps")).alias("trajectory_length"), F.struct(*length_stats("calls")).alias("tool_calls_per_row"), F.struct(*length_stats("query")).alias("query_length"),
    )


def file_type(rows: DataFrame, detected: str, order: str, name: str) -> DataFrame:
    """The type of a file from its first row; prompts of merged sources or in a file named so are merged prompts."""
    first = rows.agg(F.min_by(detected, order).alias("t"), F.count("*").alias("n"))
    merged = F.lit("merged" in name)
    kind = F.when(F.col("n") == 0, "empty_or_unknown").when((F.col("t") == "final_prompt") & merged, "merged_final_prompt").otherwise(F.col("t"))
    return first.select(kind.alias("file_type"))
