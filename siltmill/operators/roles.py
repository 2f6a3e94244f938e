"""Rows that the executor and the reviewer leave, and final prompts from chat samples.

What a teacher is asked is a column of JSON; what it answers becomes the row by column expressions. The
teacher itself is a callable that ``teacher.ask`` runs, so a deterministic one makes every row
reproducible.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions import jsonx, nested, prompts, text
from siltmill.functions.lookups import Domain, resolve, template
from siltmill.functions.text import compose_reasoning, first_truthy, once, strip
from siltmill.operators import review, steps, teacher
from siltmill.scratch import materialize
from siltmill.ship import ship

# The keys under which a sample may name its history, a summary of it, and its tools, by precedence.
HISTORY = ("history", "dialogue_history", "conversation_history")
SUMMARY = ("compressed_history", "compressed_history_text", "history_summary", "summary_history")
TOOL_FIELDS = ("fixed_tool_names", "selected_tool_names", "available_tool_names", "tool_names", "session_tool_names")
USER_KEYS = ("user", "user_query", "content")
ASSISTANT_KEYS = ("assistant", "assistant_answer", "assistant_content", "response", "answer")
# What a file plan holds, and what stands in for it.
PLAN = {"filename": "final_answer.md", "file_type": "markdown", "write_purpose": "save final answer", "content_source": "executor_final_answer"}

CHAT = "array<struct<role:string,content:string>>"


def truthy(raw: Column, name: str) -> Column:
    """A field's text; null if it is absent, null, empty, zero (as a number or as text) or false."""
    return once(F.get_json_object(raw, f"$.{name}"), lambda v: F.when(~v.isin("", "0", "false", "[]", "{}"), v))


def row_id(raw: Column, line_no: Column, prefix: str) -> Column:
    """The row's id, else its line, counted from 1."""
    return F.coalesce(truthy(raw, "id"), F.concat(F.lit(f"{prefix}_"), (line_no + 1).cast("string")))


def with_system(messages: Column, system: Column) -> Column:
    """``messages`` with ``system`` in place of a leading system message, or before them; as they are where it is null."""
    own = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    leads = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
    rest = F.when(leads, F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
    return F.when(system.isNull(), messages).otherwise(F.concat(own, rest))


def rendered(raw: Column, system: Column | None = None, model_template: Callable[[list, list], str] | None = None) -> Column:
    """The prompt of a chat sample: plain ChatML, or what a model's own template makes of its messages and tools."""
    system = F.lit(None).cast("string") if system is None else system
    messages = F.get_json_object(raw, "$.messages")
    if model_template is None:
        return text.chatml(with_system(F.coalesce(F.from_json(messages, CHAT), F.array().cast(CHAT)), system))

    @F.pandas_udf("string")
    def apply(said: pd.Series, tools: pd.Series, instead: pd.Series) -> pd.Series:
        out = []
        for m, t, s in zip(said, tools, instead, strict=True):
            m = json.loads(m) if m else []
            if s is not None:
                first = m[0] if m and isinstance(m[0], dict) and m[0].get("role") == "system" else None
                m = [{**first, "content": s}, *m[1:]] if first else [{"role": "system", "content": s}, *m]
            out.append(model_template(m, json.loads(t) if t else []))
        return pd.Series(out, dtype=object)

    return apply(messages, F.get_json_object(raw, "$.tools"), system)


def _objects(value: Column) -> Column:
    """JSON texts of the objects in a list, or of a single object."""
    none = F.array().cast("array<string>")
    listed = once(value, lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).when(v.startswith("{"), F.array(v)))
    return F.filter(F.coalesce(listed, none), lambda x: x.startswith("{"))


def recent_history(raw: Column) -> Column:
    """A line for each side of each earlier turn; null without any."""
    turns = _objects(F.coalesce(*(truthy(raw, k) for k in HISTORY)))
    said = lambda t, keys: strip(F.coalesce(first_truthy(*(F.get_json_object(t, f"$.{k}") for k in keys)), F.lit("")))

    def lines(t: Column) -> Column:
        labelled = lambda keys, label: once(said(t, keys), lambda s: F.when(s != "", F.concat(F.lit(label), s)))
        return F.array_compact(F.array(labelled(USER_KEYS, text.USER_LABEL), labelled(ASSISTANT_KEYS, text.ASSISTANT_LABEL)))

    return first_truthy(strip(F.array_join(F.flatten(F.transform(turns, lines)), "\n")))


def older_history(raw: Column) -> Column:
    return first_truthy(*(strip(F.coalesce(F.get_json_object(raw, f"$.{k}"), F.lit(""))) for k in SUMMARY))


def fixed_tools(raw: Column) -> Column:
    """The first of the fields that names a tool."""
    found = []
    for name in TOOL_FIELDS:
        listed = once(F.get_json_object(raw, f"$.{name}"), lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v)))
        names = F.filter(F.transform(listed, lambda n: strip(F.coalesce(n, F.lit("")))), lambda n: n != "")
        found.append(once(names, lambda n: F.when(F.size(n) > 0, n)))
    return F.coalesce(*found, F.array().cast("array<string>"))


def executor_requests(rows: DataFrame, domain: Domain, system: str, most: int = 6000, errors: bool = True, plan_tools: tuple[str, ...] = (), intents: tuple[str, ...] = ()) -> DataFrame:
    """``rows(line_no, raw)`` of trajectories -> what an answer is written from, with ``messages`` and ``request``.

    Rows without a question have none. With ``intents``, only rows of these intents stay.
    """
    raw, known = F.col("raw"), resolve(domain)
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    read = rows.select(
        "line_no", "raw", F.concat(F.coalesce(get("id"), F.lit("None")), F.lit("_executor")).alias("id"), get("id").alias("source_id"), strip(F.coalesce(get("user_query"), F.lit(""))).alias("user_query"),
        *(get(k).alias(k) for k in ("scenario", "student_profile", "target_competency", "tool_sampling_mode", "expected_intent")),
        nested.read_steps(F.coalesce(get("trajectory"), F.lit("[]"))).alias("steps"), older_history(raw).alias("compressed_history_text"), recent_history(raw).alias("recent_history_text"), fixed_tools(raw).alias("fixed_tool_names"),
    ).where("user_query <> ''")
    made = steps.executor_context(read, known, most=most, errors=errors)
    made = made.withColumn("intent", F.coalesce("intent", F.lit(domain.default_intent)) if domain.intents else F.lit(None).cast("string"))
    if intents and domain.intents:
        made = made.where(F.col("intent").isin(*intents))
    made = made.withColumn("answer_template", template(domain, F.col("intent")) if domain.templates else F.lit(None).cast("string"))
    plan = nested.first_file_plan(F.col("steps"), list(plan_tools), PLAN) if plan_tools else F.lit(None).cast("string")
    content = prompts.executor_content(
        F.col("user_query"), F.col("intent"), F.col("answer_template"), F.col("clarification_ask"), F.col("external_info"), F.col("compressed_history_text"), F.col("recent_history_text"),
        bool(domain.intents), bool(domain.templates),
    )
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    made = made.withColumns({"file_write_plan": plan, "messages": F.array(said("system", F.lit(system)), said("user", content))})
    return made.withColumn("request", F.to_json(F.struct("messages"))).drop("steps")  # the answer's row needs no steps


def executor_rows(answered: DataFrame, domain: Domain, reasoning: bool = True, most: int = 6000, errors: bool = True) -> DataFrame:
    """Requests with a teacher's ``answer`` (JSON of ``reasoning_content`` and ``content``) as output rows; what failed gives none."""
    told = lambda k: F.get_json_object("answer", f"$.{k}")
    full = compose_reasoning(told("reasoning_content"), told("content")) if reasoning else strip(F.coalesce(told("content"), F.lit("")))
    final = F.struct(F.lit("assistant").alias("role"), full.alias("content"))
    output = F.struct(told("reasoning_content").alias("reasoning_content"), F.coalesce(told("content"), F.lit("")).alias("content"), full.alias("text"))
    has = lambda c: F.col(c).isNotNull()
    metadata = F.struct(
        F.lit("planner_trajectory").alias("source"), "tool_names", "fixed_tool_names", "has_tool_error", has("file_write_plan").alias("has_file_write_plan"), F.lit(False).alias("file_written"),
        F.lit(errors).alias("include_tool_errors"), F.lit(reasoning).alias("include_reasoning"), F.when(has("answer_template"), F.col("intent")).alias("answer_template_intent"),
        has("clarification_ask").alias("has_clarification_ask"), has("compressed_history_text").alias("has_compressed_history"), has("recent_history_text").alias("has_recent_history"),
        F.lit(most).alias("max_external_chars"), F.col("tool_sampling_mode").alias("planner_tool_sampling_mode"), F.try_parse_json(F.get_json_object("raw", "$.metadata")).alias("source_metadata"),
    )
    return answered.where("answer is not null").select(
        "line_no", "id", F.lit(domain.name).alias("domain"), "source_id", "user_query", "scenario", "student_profile", "target_competency", "intent", "answer_template", "clarification_ask",
        "compressed_history_text", "recent_history_text", "external_info", F.try_parse_json("file_write_plan").alias("file_write_plan"), F.lit(None).cast("string").alias("file_write_result"),
        F.concat("messages", F.array(final)).alias("messages"), output.alias("executor_raw_output"), metadata.alias("metadata"),
    )


def review_requests(rows: DataFrame, domain: Domain, system: str, most: int = 12000) -> DataFrame:
    """``rows(line_no, raw)`` of executor samples with the id of their review, the ``answer_text`` and ``request``."""
    raw = F.col("raw")
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    source = F.coalesce(truthy(raw, "id"), truthy(raw, "source_id"))
    answer = prompts.last_answer(F.coalesce(F.from_json(get("messages"), CHAT), F.array().cast(CHAT)), get("executor_raw_output.text"), most)
    info = F.coalesce(first_truthy(get("external_info")), F.lit(prompts.NO_INFO))
    read = rows.select(
        "line_no", "raw", F.concat(source, F.lit("_reviewer")).alias("id"), get("id").alias("source_id"), F.coalesce(first_truthy(get("domain"), get("metadata.domain")), F.lit(domain.name)).alias("domain"),
        get("user_query").alias("user_query"), answer.alias("answer_text"), F.left(info, F.lit(most)).alias("info") if most > 0 else info.alias("info"),
    )
    content = prompts.reviewer_content(F.col("user_query"), F.col("answer_text"), get("intent"), F.col("info"), get("scenario"), get("student_profile"), get("target_competency"), most)
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return read.withColumn("request", F.to_json(F.struct(F.array(said("system", F.lit(system)), said("user", content)).alias("messages"))))


def reviewed(requests: DataFrame, ask: Callable[[dict], dict], retries: int = 5) -> DataFrame:
    """``requests`` with ``review``, the validated payload; rows whose answer breaks the protocol are asked again,
    and the first still bad after ``retries`` rounds fails the job."""
    pending, done = requests, None
    for _ in range(max(1, retries)):
        said = teacher.ask(pending, "request", ask, 1)
        payload = jsonx.strict_object(F.get_json_object("answer", "$.content"))
        judged = said.withColumn("review", F.when(jsonx.review_problem(payload).isNull() & payload.isNotNull(), F.to_json(payload)))
        judged = materialize(judged.drop("answer", "error"), "reviews")
        good = judged.where("review is not null")
        done = good if done is None else done.unionByName(good)
        pending = judged.where("review is null").drop("review")
        if pending.isEmpty():
            return done
    raise ValueError(f"no valid review of {pending.first()['id']} after {retries} rounds")


def review_rows(done: DataFrame, min_pass_score: int = 3) -> DataFrame:
    """Output rows of ``reviewed``: texts stripped, and a pass below ``min_pass_score`` turned into a reject."""
    get = lambda k: F.get_json_object("review", f"$.{k}")
    score = get("score").cast("long")
    issue = "array<struct<type:string,message:string,evidence:string>>"
    clean = lambda c: F.when(c.isNotNull(), strip(c))
    issues = F.transform(F.from_json(get("issues"), issue), lambda i: F.struct(clean(i["type"]).alias("type"), clean(i["message"]).alias("message"), clean(i["evidence"]).alias("evidence")))
    hints = F.transform(F.from_json(get("suggestions"), "array<string>"), strip)
    own = F.struct(get("decision").alias("decision"), score.alias("score"), issues.alias("issues"), hints.alias("suggestions"))
    metadata = F.struct("domain", "user_query", F.lit(min_pass_score).alias("min_pass_score"), F.length("answer_text").cast("long").alias("reviewed_answer_chars"))
    return done.select(
        "line_no", "id", "source_id", F.col("source_id").alias("source_sample_id"), F.lit("reviewer").alias("role"), F.lit("executor").alias("source_role"), review.gate(get("decision"), score, min_pass_score).alias("decision"),
        score.alias("score"), issues.alias("issues"), hints.alias("suggestions"), own.alias("reviewer_raw_output"), metadata.alias("metadata"),
    )


def repaired(raw: Column, changed: Column, intent: Column, domain: Domain) -> Column:
    """A trajectory row as JSON text in which the steps numbered in ``changed`` (among those that are objects) have
    ``intent``, with all that follows from it. Nested open objects are patched in Python, only in rows that change."""
    from pyspark.sql import SparkSession

    ship(SparkSession.active())

    @F.pandas_udf("string")
    def patch(lines: pd.Series, which: pd.Series, intents: pd.Series) -> pd.Series:
        return pd.Series([repair(json.loads(r), list(w), i, domain) if len(w) else r for r, w, i in zip(lines, which, intents, strict=True)], dtype=object)

    return patch(raw, changed, intent)


def _known(name: object, domain: Domain) -> str | None:
    name = str(name or "").strip()
    name = domain.aliases.get(name, name)
    return name if name in domain.intents else None


def repair(row: dict, changed: list[int], intent: str, domain: Domain) -> str:
    objects = [s for s in row["trajectory"] if isinstance(s, dict)]
    for k in changed:
        output, said = objects[k].get("planner_output") or {}, objects[k].get("planner_raw_output") or {}
        output["intent"] = intent
        content = json.dumps({"intent": intent, "action": output.get("action")}, ensure_ascii=False)
        thought = (said.get("reasoning_content") or "").strip()
        said |= {"content": content, "normalized_content": content, "text": f"<think>\n{thought}\n</think>\n{content}" if thought else content}
        for notes in (objects[k].get("intent_diagnostics"), said.get("intent_diagnostics")):
            if isinstance(notes, dict):
                notes["content_intent"] = intent
                for other, flag in (("reasoning_intent", "reasoning_content_conflict"), ("expected_intent", "expected_intent_conflict")):
                    named = _known(notes.get(other), domain)
                    notes[flag] = bool(named and named != intent)
    metadata = row.setdefault("metadata", {})
    if isinstance(metadata, dict):
        metadata |= {"empty_tool_call_intent_repaired": True, "empty_tool_call_intent_repaired_steps": len(changed)}
    row["empty_tool_call_intent_backfill_count"] = int(row.get("empty_tool_call_intent_backfill_count") or 0) + len(changed)
    return json.dumps(row, ensure_ascii=False)
