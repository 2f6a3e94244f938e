"""Prompt assembly for planner, executor and reviewer, and intent inference from free text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from siltmill.functions.lookups import Domain, hinted_intent, resolve
from siltmill.functions.text import history_context, once, strip, truncate
from siltmill.ship import ship

# Section titles and stand-ins.
QUERY, INTENT, ADVICE, ASK, INFO = "【用户问题】", "【识别意图】", "【回答建议】", "【规划阶段追问建议】", "【外部参考信息】"
SCENE, STUDENT, TARGET, ANSWER, REFERENCE = "【场景】", "【学生画像】", "【目标能力】", "【执行阶段回答】", "【参考意图】"
NO_INFO, NO_TEMPLATE = "无外部补充信息。", "无特定回答模板，请按通用要求作答。"
REFERENCE_NOTE = "请优先按该参考意图保持整条规划轨迹的 intent 一致；该字段只用于当前数据校正，真实场景不会提供。"
# What negates an intent named after it, within eight characters.
NEGATIONS = ("不", "非", "不是", "并非", "不属于", "不归为", "不能归为")


def _text(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def _or(c: Column, default: str) -> Column:
    return once(_text(c), lambda t: F.when(t != "", t).otherwise(default))


def section(title: str, c: Column, always: bool = False) -> Column:
    """Title and text; null, so left out of a join of sections, if there is no text."""
    made = lambda t: F.concat(F.lit(title + "\n"), t)
    return made(_text(c)) if always else once(_text(c), lambda t: F.when(t != "", made(t)))


def planner_content(query: Column, reference_intent: Column, compressed: Column, recent: Column) -> Column:
    note = F.when(_text(reference_intent) != "", F.concat(F.lit(REFERENCE + "\n"), reference_intent, F.lit("\n" + REFERENCE_NOTE)))
    context = history_context(compressed, recent)
    return F.concat_ws("\n\n", F.coalesce(query, F.lit("")), note, F.when(context != "", context))


def executor_content(query: Column, intent: Column, template: Column, ask: Column, info: Column, compressed: Column, recent: Column, has_intent: bool = True, has_template: bool = True, has_ask: bool = True) -> Column:
    """The sections a domain has, then older and recent history."""
    body = F.concat_ws(
        "\n\n", section(QUERY, query, True), section(INTENT, intent, True) if has_intent else F.lit(None),
        F.concat(F.lit(ADVICE + "\n"), _or(template, NO_TEMPLATE)) if has_template else F.lit(None), section(ASK, ask) if has_ask else F.lit(None),
        F.concat(F.lit(INFO + "\n"), _or(info, NO_INFO)),
    )
    history = [section("【压缩历史对话】", compressed), section("【近期历史对话】", recent)]
    return strip(F.concat_ws("\n\n", body, *history))


def reviewer_content(query: Column, answer: Column, intent: Column, info: Column, scene: Column, student: Column, target: Column, max_answer: int = 12000) -> Column:
    cut = F.left(_text(answer), F.lit(max_answer)) if max_answer > 0 else _text(answer)
    return F.concat_ws(
        "\n\n", section(QUERY, query, True), section(INTENT, intent), section(SCENE, scene), section(STUDENT, student), section(TARGET, target),
        F.concat(F.lit(INFO + "\n"), _or(info, NO_INFO)), F.concat(F.lit(ANSWER + "\n"), cut),
    )


def last_answer(messages: Column, raw_text: Column, most: int = 12000) -> Column:
    """The last assistant message, else the raw output, cut at ``most`` characters."""
    said = F.filter(messages, lambda m: m["role"] == "assistant")
    text = F.when(F.size(said) > 0, _text(F.element_at(said, -1)["content"])).otherwise(_text(raw_text))
    return F.left(text, F.lit(most)) if most > 0 else text


def shortened(c: Column, most: int) -> Column:
    return truncate(c, most)


# How a text states its decision for an intent, which stands for {one}; letters of any case.
DECISIONS = (
    "(?:整体意图|用户意图|意图|intent|类别|分类)\\s*(?:是|为|应为|应该是|判定为|判断为|归为|归类为|属于|:|：)\\s*[“\"'「『]?({one})",
    "(?:归为|归类为|判定为|判断为|属于|应该是|应为|算是|视为)\\s*[“\"'「『]?({one})[”\"'」』]?\\s*(?:类别|类|意图)?",
    "[“\"'「『]?({one})[”\"'」』]?\\s*(?:类别|类|意图)",
    "({one})\\s*(?:更合适|更准确|更贴切)",
)


def _patterns(names: list[str]) -> list[re.Pattern]:
    one = "|".join(map(re.escape, names))
    return [re.compile(p.replace("{one}", one), re.IGNORECASE) for p in DECISIONS]


def intent_in(text: str | None, domain: Domain, patterns: list[re.Pattern] | None = None) -> str | None:
    """The intent that the last decision in a text names, if no negation stands before it; else that of the first alias found."""
    if not text or not domain.intents:
        return None
    last = None
    for p in patterns or _patterns(list(domain.intents)):
        for m in p.finditer(text):
            before = text[max(0, m.start() - 8) : m.start()]
            if not any(n in before for n in NEGATIONS) and (last is None or m.start() >= last[0]):
                last = (m.start(), m[1])
    if last:
        return last[1]
    return next((c if c in domain.intents else None for a, c in domain.aliases.items() if a in text), None)


def intent_from_text(text: Column, domain: Domain) -> Column:
    """Vectorised ``intent_in``: the look-behind over a match's surroundings is beyond one expression."""

    ship(SparkSession.active())

    @F.pandas_udf("string")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns = _patterns(list(domain.intents)) if domain.intents else []
        for b in batches:
            yield b.map(lambda t: intent_in(t, domain, patterns))

    return infer(text)


def infer_intent(explicit: Column, reasoning: Column, content: Column, tools: Column, expected: Column, domain: Domain) -> Column:
    """The first that gives a known intent: what is stated, the reasoning, the content, the tools called, what was expected."""
    known = resolve(domain)
    return F.coalesce(known(explicit), intent_from_text(reasoning, domain), intent_from_text(content, domain), hinted_intent(domain, tools), known(expected), F.lit(domain.default_intent or ""))
