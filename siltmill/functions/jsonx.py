"""Lenient and strict JSON expressions, on VARIANT so that open objects keep their shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.text import first_truthy, once, strip


def parsed(text: Column) -> Column:
    """VARIANT, or null where ``text`` isn't JSON as a whole.

    Spark's parser stops behind the first value, whatever follows. So the text is parsed as the first of a list
    of two, whose second is the text's hash; without that one, the list ended within the text or didn't end.
    """
    mark = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    return once(pair, lambda p: F.when(F.try_variant_get(p, "$[1]", "bigint") == mark, F.variant_get(p, "$[0]", "variant")))


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID."""
    return F.regexp_extract(F.schema_of_variant(v), r"^[A-Z]+", 0)


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def lenient_object(text: Column) -> Column:
    """From raw text, else the first fenced block, else from the first brace to the last; null if none parses."""
    t = strip(F.coalesce(text, F.lit("")))
    fenced = F.regexp_extract(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    outer = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    whole = parsed(t)
    return F.when(whole.isNotNull(), whole).when(fenced != "", parsed(fenced)).otherwise(parsed(outer))


def strict_object(text: Column) -> Column:
    """The whole text, or one fence around all of it; null unless it is an object."""
    t = strip(F.coalesce(text, F.lit("")))
    fenced = F.regexp_extract(t, r"(?s)^```(?:json)?\s*(.*?)\s*```$", 1)
    v = parsed(F.when(fenced != "", fenced).otherwise(t))
    return F.when(is_object(v), v)


def arguments(text: Column) -> Column:
    """Tool arguments as JSON text: an object as it is, anything else wrapped as a query."""
    v = parsed(text)
    return F.when(is_object(v), F.to_json(v)).otherwise(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("query"))))


def canonical(text: Column) -> Column:
    """Sorted keys, no spaces, non-ASCII kept; null if it isn't JSON."""
    return F.to_json(parsed(text))


def field(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def tool_name(v: Column) -> Column:
    """Nested under ``function`` or flat."""
    return F.coalesce(first_truthy(field(v, "$.function.name"), field(v, "$.name")), F.lit(""))


def has_key(text: Column, key: str) -> Column:
    """Whether the object has the key at all; absent and null differ for some fields."""
    return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))


def row_type(text: Column) -> Column:
    """The kind of a row, from the keys it has."""
    has = lambda k: has_key(text, k)
    executor = has("executor_raw_output") | F.coalesce(F.get_json_object(text, "$.id").endswith("_executor"), F.lit(False))
    return (
        F.when(has("trajectory"), "planner_trajectory")
        .when(has("prompt"), "final_prompt")
        .when(has("messages") & executor, "executor_answer_sft")
        .when(has("messages"), "message_sft")
        .when(has("user_query"), "seed")
        .otherwise("unknown")
    )


def signature(text: Column, by: str = "auto") -> Column:
    """What makes two rows the same: the first body field that isn't empty, the id, or the whole row."""
    return once(parsed(text), lambda v: signature_of(v, text, by))


def signature_of(v: Column, text: Column, by: str = "auto") -> Column:
    """``signature`` of a text whose ``parsed`` is at hand."""
    raw = F.coalesce(F.to_json(v), text)
    if by == "id":
        return F.coalesce(first_truthy(field(v, "$.id")), F.sha1(raw))
    full = lambda c: once(c, lambda x: F.when(~x.isin("null", '""', "[]", "{}"), x))
    bodies = [F.concat(F.lit(name + ":"), full(F.to_json(F.try_variant_get(v, f"$.{name}", "variant")))) for name in ("messages", "prompt", "conversations", "text", "query")]
    return F.sha1(F.coalesce(*bodies, raw))


def review_problem(v: Column) -> Column:
    """Null for a valid review, else the first reason why it isn't one.

    decision pass or reject; score a whole number 1 to 5 and no boolean; issues objects with text in type
    and message, and evidence text or absent; suggestions texts.
    """
    decision = strip(F.coalesce(field(v, "$.decision"), F.lit("")))
    issues, suggestions = F.variant_get(v, "$.issues", "variant"), F.variant_get(v, "$.suggestions", "variant")
    is_list = lambda x: F.coalesce(F.schema_of_variant(x).startswith("ARRAY"), F.lit(False))
    items = F.try_variant_get(v, "$.issues", "array<variant>")
    text = lambda x, p: strip(F.coalesce(F.when(kind(F.variant_get(x, p, "variant")) == "STRING", field(x, p)), F.lit("")))
    good = lambda x: is_object(x) & (text(x, "$.type") != "") & (text(x, "$.message") != "")
    evidence = lambda x: F.coalesce(kind(F.variant_get(x, "$.evidence", "variant")).isin("STRING", "VOID"), F.lit(True))
    hints = F.try_variant_get(v, "$.suggestions", "array<variant>")
    score = F.variant_get(v, "$.score", "variant")
    return (
        F.when(~is_object(v), "not an object")
        .when(~decision.isin("pass", "reject"), "decision")
        .when(~F.coalesce((kind(score) == "BIGINT") & F.try_variant_get(v, "$.score", "bigint").between(1, 5), F.lit(False)), "score")
        .when(~is_list(issues), "issues")
        .when(~F.coalesce(F.forall(items, lambda x: good(x) & evidence(x)), F.lit(False)), "issue")
        .when(~is_list(suggestions), "suggestions")
        .when(~F.coalesce(F.forall(hints, lambda x: kind(x) == "STRING"), F.lit(False)), "suggestion")
    )
