"""What of a JSON row is compared for near-duplicates, and which intent and mode it has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions import jsonx, nested, text
from siltmill.functions.lookups import HEALTH, Domain, resolve


def _get(raw: Column, path: str) -> Column:
    return F.coalesce(F.get_json_object(raw, path), F.lit(""))


def prompt_text(raw: Column, dedup_key: str = "auto") -> Column:
    """Of a rendered prompt: all of it, its last user turn, its last answer, or both. auto compares question and
    answer of executor rows and the answer of others. What is empty falls back to the whole prompt."""
    prompt = _get(raw, "$.prompt")
    user = text.last_turn(prompt, text.USER)
    said = text.strip_think(text.last_turn(prompt, text.ASSISTANT))
    both = F.concat_ws("\n", text.first_truthy(user), text.first_truthy(said))
    found = {"prompt": prompt, "user": user, "assistant": said, "qa": both}
    found["auto"] = F.when(_get(raw, "$.metadata.merge_source") == "executor_answer", both).otherwise(said)
    if dedup_key not in found:
        raise ValueError(f"unknown dedup_key {dedup_key}")
    return text.or_default(found[dedup_key], prompt)


def trajectory_text(raw: Column) -> Column:
    """The question and the last step's intent, action, ask, finish reason and calls, a line each."""
    steps = nested.read_steps(F.coalesce(F.get_json_object(raw, "$.trajectory"), F.lit("[]")))
    last = F.element_at(F.when(F.size(steps) > 0, steps), -1)["planner_output"]
    calls = F.flatten(F.transform(last["tool_calls"], lambda c: F.array(c["name"], F.coalesce(c["arguments"], F.lit("{}")))))
    parts = F.concat(F.array(last["intent"], last["action"], last["ask"], last["finish_reason"]), F.coalesce(calls, F.array().cast("array<string>")))
    final = F.array_join(F.filter(parts, lambda p: p != ""), "\n")
    return F.concat(_get(raw, "$.user_query"), F.lit("\n"), F.coalesce(final, F.lit("")))


def messages_text(raw: Column) -> Column:
    """Contents of all messages but those of system and tools."""
    listed = F.from_json(F.when(_get(raw, "$.messages").startswith("["), _get(raw, "$.messages")), "array<string>")
    m = F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda x: x.startswith("{"))
    kept = F.filter(m, lambda x: ~F.coalesce(F.get_json_object(x, "$.role"), F.lit("")).isin("system", "tool"))
    return F.array_join(F.transform(kept, lambda x: F.coalesce(F.get_json_object(x, "$.content"), F.lit(""))), "\n")


def dedup_text(raw: Column, text_field: str | None = None, dedup_key: str = "auto") -> Column:
    if text_field:
        return _get(raw, f"$.{text_field}")
    kind = jsonx.row_type(raw)
    return (
        F.when(kind == "seed", _get(raw, "$.user_query"))
        .when(kind == "planner_trajectory", trajectory_text(raw))
        .when(kind.isin("message_sft", "executor_answer_sft"), messages_text(raw))
        .when(kind == "final_prompt", prompt_text(raw, dedup_key))
        .otherwise(F.coalesce(jsonx.canonical(raw), raw))
    )


def row_intent(raw: Column, domain: Domain = HEALTH) -> Column:
    """The last known intent of the steps, else of the metadata, else of the row, else the first of the domain's
    intents that the prompt names; null without one."""
    known = resolve(domain)
    steps = nested.read_steps(F.coalesce(F.get_json_object(raw, "$.trajectory"), F.lit("[]")))
    fields = ("metadata.intent", "metadata.answer_template_intent", "intent", "answer_template_intent", "expected_intent")
    prompt = _get(raw, "$.prompt")
    return F.coalesce(nested.last_intent(steps, known), *(known(F.get_json_object(raw, f"$.{f}")) for f in fields), *(F.when(F.contains(prompt, F.lit(i)), i) for i in domain.intents))


def sampling_mode(raw: Column) -> Column:
    paths = ("$.tool_sampling_mode", "$.metadata.planner_tool_sampling_mode", "$.metadata.tool_sampling_mode")
    return F.coalesce(*(text.first_truthy(text.strip(F.get_json_object(raw, p))) for p in paths), F.lit("(missing)"))
