"""A trajectory becomes one chat sample per step, each with the history before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.functions import nested


def explode_steps(rows: DataFrame, system: str, steps: str = "steps", reasoning: bool = True, tools: str | None = None) -> DataFrame:
    """``(id, domain, tools, messages, metadata)``, a row for each step up to the first forbidden call.

    messages are the system and user messages, what all earlier steps left, and the step's own
    message, which isn't repeated if the history already ends with it. The history is a slice of the
    row's own array, so nothing is shuffled. ``tools`` names a column of tool names, or of what
    ``nested.exposed_tools`` gives.
    """
    read = rows.withColumn("__s", nested.until_forbidden(F.col(steps)))
    read = read.select("*", F.posexplode("__s").alias("__i", "__step"))
    none = F.lit(None).cast("array<struct<name:string,arguments:string>>")
    lead = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"), none.alias("tool_calls")),
        F.struct(F.lit("user").alias("role"), F.coalesce(F.col("user_query"), F.lit("")).alias("content"), none.alias("tool_calls")),
    )
    before = F.when(F.col("__i") > 0, F.slice("__s", F.lit(1), F.col("__i"))).otherwise(F.slice("__s", 1, 0))
    history = F.concat(lead, F.flatten(F.transform(before, lambda s: nested.step_messages(s, reasoning))))
    own, last = nested.own_message(F.col("__step"), reasoning), F.element_at(F.col("__h"), -1)
    calls = F.col("__step.planner_output.action") == "tool_call"
    same = F.when(calls, last.eqNullSafe(F.col("__own"))).otherwise(last["content"].eqNullSafe(F.col("__own.content")))
    exposed = F.col(tools) if tools else F.array().cast("array<string>")
    if tools and rows.schema[tools].dataType.simpleString() == "array<string>":
        exposed = F.filter(exposed, lambda t: ~t.isin(*nested.FORBIDDEN))
    made = read.withColumns({"__h": history, "__own": own})
    return made.select(
        F.concat(F.col("id").cast("string"), F.lit("_step_"), F.col("__step.step").cast("string")).alias("id"),
        F.col("domain"), exposed.alias("tools"),
        F.when(F.coalesce(same, F.lit(False)), F.col("__h")).otherwise(F.concat("__h", F.array("__own"))).alias("messages"),
        F.struct(
            F.col("domain"), F.col("id").alias("source_id"), F.col("__step.step").alias("step"), F.col("__step.planner_output.action").alias("action"),
            F.lit(reasoning).alias("include_reasoning"), F.col("__step.planner_overridden").alias("planner_overridden"),
        ).alias("metadata"),
    )


def executor_context(rows: DataFrame, resolve, steps: str = "steps", most: int = 6000, errors: bool = True) -> DataFrame:
    """``rows`` with what an answer is written from: intent, ask, external_info, tool_names, has_tool_error."""
    s = F.col(steps)
    return rows.withColumns({
        "intent": nested.last_intent(s, resolve, F.col("expected_intent")), "clarification_ask": nested.last_ask(s),
        "external_info": nested.external_info(s, most, errors), "tool_names": nested.tool_names(s), "has_tool_error": nested.has_tool_error(s),
    })


def repair_intents(rows: DataFrame, resolve=None, steps: str = "steps") -> DataFrame:
    """``rows`` with back-filled intents and the number of steps changed; without a domain's ``resolve`` nothing changes."""
    if resolve is None:
        return rows.withColumn("changed_steps", F.lit(0).cast("long"))
    fixed = rows.withColumn("__fixed", nested.backfill(F.col(steps), resolve))
    return fixed.withColumn("changed_steps", nested.backfill_count(F.col(steps), F.col("__fixed"))).withColumn(steps, F.col("__fixed")).drop("__fixed")
