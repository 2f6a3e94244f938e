"""Checks of synthesised rows; each gives null for a good row, else the first reason against it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.text import strip

# Phrases that must not appear in answers.
SELF_NAMES = ("作为 AI 模型", "作为AI模型", "I am ChatGPT", "I am Qwen", "我是 ChatGPT", "我是Qwen", "我是 Qwen")
LEAKS = ("已识别意图", "识别意图", "显式意图", "意图字段", "回答模板", "answer_template", "规划动作", "planning_finish", "工具调用", "下游模块")


def _field(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def _any(c: Column, phrases) -> Column:
    test = F.lit(False)
    for p in phrases:
        test = test | F.contains(c, F.lit(p))
    return test


def _names(c: Column, name: str) -> Column:
    return F.contains(c, F.lit(name)) | F.contains(c, F.lit(name.replace(" ", "")))


def _length(label: str, c: Column) -> Column:
    return F.concat(F.lit(f"{label}="), F.length(c).cast("string"))


def identity_answer(user_query: Column, answer: Column, reasoning: Column, name: str, team: str) -> Column:
    q, a, r = _field(user_query), _field(answer), _field(reasoning)
    return (
        F.when((q == "") | (a == "") | (r == ""), "empty_field")
        .when(~F.length(q).between(4, 200), _length("user_query_length", q))
        .when(~F.length(a).between(100, 1200), _length("answer_length", a))
        .when(~_names(a, name), "missing_name")
        .when(~_names(a, team), "missing_team")
        .when(_any(a, SELF_NAMES), "forbidden_phrase")
    )


def identity_plan(user_query: Column, reasoning: Column) -> Column:
    q, r = _field(user_query), _field(reasoning)
    return (
        F.when((q == "") | (r == ""), "empty_field")
        .when(~F.length(q).between(4, 200), _length("user_query_length", q))
        .when(~F.length(r).between(30, 400), _length("reasoning_length", r))
        .when(~_any(r, ("planning_finish", "结束规划")), "reasoning_missing_finish_signal")
    )


def no_intent_answer(answer: Column, reasoning: Column) -> Column:
    a = _field(answer)
    return (
        F.when(a == "", "empty_answer")
        .when(F.length(a) < 80, _length("answer_too_short", a))
        .when(F.length(a) > 2500, _length("answer_too_long", a))
        .when(_any(F.concat(_field(reasoning), F.lit("\n"), a), LEAKS), "leak_hidden_field_phrase")
    )


def intent_conflicts(content: Column, reasoning: Column, expected: Column) -> tuple[Column, Column]:
    """(reasoning against content, content against what was expected); null intents conflict with nothing."""
    return F.coalesce(content != reasoning, F.lit(False)), F.coalesce(content != expected, F.lit(False))
