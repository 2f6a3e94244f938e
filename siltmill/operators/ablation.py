"""Executor answers rewritten so that neither intent nor answer template reaches the model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.text import compose_reasoning, strip

# Fixed values.
NO_INFO = "无外部补充信息。"
QUERY_TITLE, INFO_TITLE = "【用户问题】", "【外部参考信息】"


def user_prompt(query: Column, info: Column) -> Column:
    known = strip(F.coalesce(info, F.lit("")))
    body = F.when(known != "", known).otherwise(NO_INFO)
    return F.concat(F.lit(QUERY_TITLE + "\n"), strip(query), F.lit("\n\n" + INFO_TITLE + "\n"), body, F.lit("\n"))


def copy_rows(rows: DataFrame, system: str, reasoning: bool = False, require_info: bool = False, source: str = "executor_no_intent_copy") -> DataFrame:
    """``(id, source_id, user_query, intent, external_info, messages, executor_raw_output, metadata)`` without any model call.

    ``rows`` has id, source_id, user_query, intent, external_info, reasoning_content and content. Rows without
    a question or an answer are dropped, with ``require_info`` also those without external information.
    """
    q, a = strip(F.coalesce("user_query", F.lit(""))), strip(F.coalesce("content", F.lit("")))
    info = F.coalesce("external_info", F.lit(""))
    said = compose_reasoning(F.col("reasoning_content"), F.col("content")) if reasoning else a
    kept = rows.where((q != "") & (a != "") & ((strip(info) != "") if require_info else F.lit(True)))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return kept.select(
        F.concat(F.col("id").cast("string"), F.lit("_no_intent")).alias("id"), F.coalesce(F.when(F.col("source_id") != "", F.col("source_id")), F.col("id").cast("string")).alias("source_id"),
        q.alias("user_query"), "intent", info.alias("external_info"),
        F.array(message("system", F.lit(system)), message("user", user_prompt(q, info)), message("assistant", said)).alias("messages"),
        F.struct(F.when(strip(F.coalesce("reasoning_content", F.lit(""))) != "", strip(F.col("reasoning_content"))).alias("reasoning_content"), a.alias("content"), said.alias("text")).alias("executor_raw_output"),
        F.struct(
            F.lit(source).alias("source"), F.lit(source == "executor_no_intent_api").alias("synthesized_by_api"), F.lit(True).alias("ablation_no_intent"), F.lit(True).alias("ablation_no_answer_template"),
            F.lit("user_query,external_info").alias("model_input_fields"), F.col("intent").alias("original_intent"), (strip(info) != "").alias("has_external_info"), F.lit(reasoning).alias("include_reasoning"),
        ).alias("metadata"),
    )
