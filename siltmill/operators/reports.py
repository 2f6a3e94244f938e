"""Typed reports over JSON rows: all counters in one aggregation, all figures in another.

Each row yields the (counter, value) pairs it adds to; one grouped count over these, with the first
row that had each value, gives every frequency table of the report at once. Sums and lengths come from
one more aggregate. The driver sees report-sized results only: ``most`` values of each counter by name and
all others in one figure; ``counters`` has every value, as a table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.functions import nested, text
from siltmill.functions.numbers import length_stats

MISSING, OTHERS = "(missing)", "(others)"
# Tools that search, and the text that stands for no external information.
SEARCH_TOOLS = ("search_rag", "search_web", "search_food_web", "search_exercise_web", "search_tcm_web", "search_emotion_web", "search_safety_web")
NO_INFO = "无外部补充信息。"


def _at(path: str) -> Column:
    return F.get_json_object("raw", path)


def _str(path: str, default: str = "") -> Column:
    """Python's ``str(x or default)`` of a scalar."""
    v = _at(path)
    return F.coalesce(F.when(~v.isin("", "false", "0", "[]", "{}"), v), F.lit(default))


def _true(path: str) -> Column:
    v = _at(path)
    return F.coalesce(~v.isin("", "false", "0", "0.0", "[]", "{}"), F.lit(False))


def _pos(path: str) -> Column:
    return F.coalesce(_at(path).try_cast("double") > 0, F.lit(False))


def _listed(path: str) -> Column:
    """Array elements as JSON text; empty unless it is an array."""
    v = _at(path)
    return F.coalesce(F.when(v.startswith("["), F.from_json(v, "array<string>")), F.array().cast("array<string>"))


def _objects(items: Column) -> Column:
    return F.filter(items, lambda x: x.startswith("{"))


def _tool_names(items: Column) -> Column:
    names = F.transform(_objects(items), lambda t: F.coalesce(F.get_json_object(t, "$.function.name"), F.lit("")))
    return F.filter(names, lambda n: n != "")


def _one(name: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(name).alias("counter"), value.alias("value"), F.lit(1).cast("long").alias("n")))


def _many(name: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("counter"), v.alias("value"), F.lit(1).cast("long").alias("n")))


def _sum(name: str, value: Column, n: Column) -> Column:
    return F.array(F.struct(F.lit(name).alias("counter"), value.alias("value"), n.cast("long").alias("n")))


@dataclass
class Spec:
    """What a type of row adds: arrays of counts, flags that count rows, whole numbers that add up, lengths (one or many a row)."""

    derived: dict[str, Column] = field(default_factory=dict)
    counts: list[Column] = field(default_factory=list)
    flags: dict[str, Column] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)
    lengths: dict[str, Column] = field(default_factory=dict)
    many: dict[str, Column] = field(default_factory=dict)
    shares: tuple[str, ...] = ()


def seed_spec() -> Spec:
    return Spec(
        counts=[_one("expected_intent", _str("$.expected_intent")), _one("scenario", _str("$.scenario"))],
        flags={"rag_summary_present": text.strip(_str("$.rag_summary")) != ""}, lengths={"query_length": F.length(_str("$.user_query"))}, shares=("rag_summary_present",),
    )


def trajectory_spec() -> Spec:
    s = F.col("steps")
    act = lambda x: F.coalesce(F.when(x["planner_output"]["action"] != "", x["planner_output"]["action"]), F.lit(MISSING))
    intent = lambda x: F.coalesce(F.when(x["planner_output"]["intent"] != "", x["planner_output"]["intent"]), F.lit(MISSING))
    calling = F.filter(s, lambda x: act(x) == "tool_call")
    calls = F.filter(F.transform(F.flatten(F.transform(calling, lambda x: x["planner_output"]["tool_calls"])), lambda c: F.coalesce(c["name"], F.lit(""))), lambda n: n != "")
    n_calls = F.size(F.flatten(F.transform(calling, lambda x: x["planner_output"]["tool_calls"])))
    seen = F.flatten(F.transform(s, lambda x: x["observations"]))
    mode, tools = _str("$.tool_sampling_mode", MISSING), _listed("$.tools")
    last = F.element_at(s, -1)
    steps_json = _objects(_listed("$.trajectory"))
    clash = lambda k: F.exists(steps_json, lambda x: F.coalesce(F.get_json_object(x, f"$.intent_diagnostics.{k}") == "true", F.lit(False)))
    blank = lambda x: text.strip(F.coalesce(x["planner_raw_output"]["raw_content"], F.lit(""))) == ""
    total, final_ok = F.size(_listed("$.trajectory")), F.size(_listed("$.trajectory")) > 0
    return Spec(
        derived={"steps": nested.read_steps(F.coalesce(_at("$.trajectory"), F.lit("[]")))},
        counts=[
            _one("scenario", _str("$.scenario", MISSING)), _one("tool_sampling_mode", mode), _sum("steps_by_sampling_mode", mode, total), _sum("tool_calls_by_sampling_mode", mode, n_calls),
            _one("expected_intent", _str("$.expected_intent", MISSING)), _many("step_intent", F.transform(s, intent)), _many("step_action", F.transform(s, act)),
            F.when(final_ok, _one("final_action", F.coalesce(act(last), F.lit(MISSING)))), F.when(final_ok, _one("final_intent", F.coalesce(intent(last), F.lit(MISSING)))),
            _many("exposed_tools", _tool_names(tools)), _many("tool_calls_by_name", calls),
            _many("observations_by_name", F.filter(F.transform(seen, lambda o: F.coalesce(o["name"], F.lit(""))), lambda n: n != "")),
        ],
        flags={
            "rows_with_tool_call": n_calls > 0, "rows_with_search_tool_call": F.exists(calls, lambda c: c.isin(*SEARCH_TOOLS)),
            "rows_with_no_tools": (F.size(tools) == 0) & F.coalesce(_at("$.tools").startswith("[") | _at("$.tools").isin("", "0", "false", "{}"), F.lit(True)), "rows_with_tool_error": nested.has_tool_error(s),
            "rows_with_injected_failure": _true("$.tool_failure_enabled") | _pos("$.tool_failure_count"), "rows_with_raw_empty_tool_call": F.exists(calling, blank),
            "rows_with_forbidden_tool_call": F.exists(calls, lambda c: c.isin(*nested.FORBIDDEN)), "rows_with_intent_reference": _true("$.intent_reference_used"),
            "rows_with_reasoning_content_conflict": clash("reasoning_content_conflict"), "rows_with_expected_intent_conflict": clash("expected_intent_conflict"),
            "rows_with_empty_backfill": _pos("$.empty_tool_call_intent_backfill_count"), "missing_final": ~final_ok,
            "special_trajectory_rows": mode.isin("no_tools", "irrelevant_tools"),
        },
        sums={
            "total_steps": total, "total_tool_calls": n_calls, "rows_with_ask": F.size(F.filter(s, lambda x: act(x) == "ask_clarification")),
            "rows_with_overridden": F.size(F.filter(s, lambda x: x["planner_overridden"])), "malformed_steps": total - F.size(s), "estimated_stepwise_samples": total,
            "special_stepwise_samples": F.when(mode.isin("no_tools", "irrelevant_tools"), total).otherwise(0),
        },
        lengths={"trajectory_length": total, "tool_call_steps_per_row": F.size(calling), "tool_calls_per_row": n_calls, "query_length": F.length(_str("$.user_query"))},
        many={"observation_chars": F.transform(seen, lambda o: F.length(F.coalesce(o["content"], F.lit(""))))},
        shares=("rows_with_tool_call", "rows_with_no_tools", "special_trajectory_rows"),
    )


def message_spec() -> Spec:
    m = F.col("m")
    content = lambda x: F.coalesce(F.get_json_object(x, "$.content"), F.lit(""))
    role = lambda x: F.coalesce(F.get_json_object(x, "$.role"), F.lit(""))
    said = F.filter(m, lambda x: role(x) == "assistant")
    calls = F.flatten(F.transform(m, lambda x: F.coalesce(F.from_json(F.get_json_object(x, "$.tool_calls"), "array<struct<function:struct<name:string>>>"), F.array().cast("array<struct<function:struct<name:string>>>"))))
    names = F.filter(F.transform(calls, lambda c: F.coalesce(c["function"]["name"], F.lit(""))), lambda n: n != "")
    tools = _listed("$.tools")
    return Spec(
        derived={"m": _objects(_listed("$.messages"))},
        counts=[
            _one("action", _str("$.metadata.action", MISSING)), _many("message_roles", F.transform(m, role)),
            _one("source", F.coalesce(text.first_truthy(_str("$.metadata.source"), _str("$.metadata.source_id")), F.lit(MISSING))),
            _many("exposed_tools", _tool_names(tools)), _many("tool_calls_by_name", names),
        ],
        flags={"rows_with_exposed_tools": F.size(tools) > 0, "rows_with_tool_messages": F.exists(m, lambda x: role(x) == "tool")},
        sums={"rows_with_reasoning": F.size(F.filter(said, lambda x: F.contains(content(x), F.lit("<think>")))), "rows_with_forbidden_tool_call": F.size(F.filter(names, lambda n: n.isin(*nested.FORBIDDEN)))},
        lengths={"message_count": F.size(_listed("$.messages")), "message_content_chars": F.aggregate(m, F.lit(0), lambda a, x: a + F.length(content(x)))},
        many={"assistant_content_chars": F.transform(said, lambda x: F.length(content(x)))},
        shares=("rows_with_exposed_tools", "rows_with_tool_messages", "rows_with_reasoning"),
    )


def executor_spec() -> Spec:
    base = message_spec()
    answer = F.coalesce(text.first_truthy(_at("$.executor_raw_output.text"), _at("$.executor_raw_output.content")), F.lit(""))
    info = _str("$.external_info")
    base.counts += [
        _one("intent", _str("$.intent", MISSING)), _one("planner_tool_sampling_mode", _str("$.metadata.planner_tool_sampling_mode", MISSING)), _many("tool_names", _listed("$.metadata.tool_names")),
    ]
    base.flags |= {
        "rows_with_external_info": ~text.strip(info).isin("", NO_INFO), "rows_with_tool_error": _true("$.metadata.has_tool_error"), "rows_with_file_write_plan": _at("$.file_write_plan").isNotNull(),
        "rows_file_written": _at("$.file_write_result").isNotNull(), "rows_with_clarification_ask": _at("$.clarification_ask").isNotNull(),
    }
    base.lengths |= {"answer_chars": F.length(answer), "external_info_chars": F.length(info)}
    base.shares += ("rows_with_external_info", "rows_with_clarification_ask")
    return base


def prompt_spec(intents: list[str]) -> Spec:
    p = F.col("p")

    def first(*keys: str) -> Column:
        found = []
        for k in keys:
            v = _at(f"$.metadata.{k}")
            flag = F.initcap(v)
            plain = text.strip(F.when(~v.isin("0", "[]", "{}"), v))
            found.append(F.when(v.isin("true", "false"), flag).when(plain != "", plain))
        return F.coalesce(*found)

    inferred = text.infer_intent(p, intents)
    known = F.when(inferred != MISSING, inferred)
    intent = F.coalesce(first("intent", "answer_template_intent"), known, F.lit(MISSING))
    template = F.coalesce(first("answer_template_intent", "intent"), known, F.lit(MISSING))
    source = _str("$.metadata.merge_source", MISSING)
    names = F.when(_at("$.metadata.tool_names").startswith("["), _listed("$.metadata.tool_names")).otherwise(F.split(_str("$.metadata.tool_names"), ","))
    names = F.filter(F.transform(names, text.strip), lambda n: n != "")
    sections = text.section_flags(p)
    truth = lambda k: F.when(_true(f"$.metadata.{k}"), "True").otherwise("False")
    return Spec(
        derived={"p": _str("$.prompt")},
        counts=[
            _one("metadata_source", _str("$.metadata.source", MISSING)), _one("metadata_action", _str("$.metadata.action", MISSING)),
            _one("metadata_intent", F.coalesce(first("intent"), F.lit(MISSING))), _one("metadata_answer_template_intent", F.coalesce(first("answer_template_intent"), F.lit(MISSING))),
            _one("effective_intent", intent), _one("effective_answer_template_intent", template),
            F.when(source == "planner_final", _one("planner_final_intent", intent)), F.when(source == "executor_answer", _one("executor_answer_intent", intent)),
            _one("merge_source", source), _one("planner_tool_sampling_mode", _str("$.metadata.planner_tool_sampling_mode", MISSING)),
            *(_one(k, truth(k)) for k in ("include_tool_errors", "has_tool_error", "has_clarification_ask")), _many("tool_names", names), _one("inferred_final_action", text.infer_action(p)),
            *(_sum("prompt_sections", F.lit(k), F.when(c, 1).otherwise(0)) for k, c in sections.items()),
        ],
        flags={
            "rows_with_reasoning": sections["has_think"], "rows_with_tool_schema": sections["has_tool_schema"], "rows_with_executor_answer": source == "executor_answer",
            "rows_with_planner_final": source == "planner_final", "rows_with_nonempty_intent": intent != MISSING, "rows_with_nonempty_answer_template_intent": template != MISSING,
            "rows_with_tool_error": _true("$.metadata.has_tool_error"), "rows_with_clarification_ask": _true("$.metadata.has_clarification_ask"), "rows_with_tool_names": F.size(names) > 0,
        },
        lengths={"prompt_chars": F.length(p), "assistant_turns": text.occurrences(p, text.ANY_ASSISTANT)},
        shares=tuple(f"rows_with_{k}" for k in "reasoning tool_schema executor_answer planner_final nonempty_intent nonempty_answer_template_intent tool_error clarification_ask tool_names".split()),
    )


def spec_of(file_type: str, intents: list[str]) -> Spec:
    made = {"planner_trajectory": trajectory_spec, "executor_answer_sft": executor_spec, "planner_step_sft": message_spec, "message_sft": message_spec, "seed": seed_spec}
    if file_type in ("final_prompt", "merged_final_prompt"):
        return prompt_spec(intents)
    return made.get(file_type, Spec)()


def counters(rows: DataFrame, spec: Spec, order: str = "row_idx") -> DataFrame:
    """``(counter, value, n, first)`` of all frequency tables."""
    read = rows.withColumns(spec.derived) if spec.derived else rows
    none = F.array().cast("array<struct<counter:string,value:string,n:bigint>>")
    parts = [F.coalesce(c, none).cast("array<struct<counter:string,value:string,n:bigint>>") for c in spec.counts]
    pairs = read.select(F.col(order).alias("o"), F.explode(F.concat(none, *parts)).alias("c"))
    return pairs.groupBy("c.counter", "c.value").agg(F.sum("c.n").alias("n"), F.min("o").alias("first"))


def figures(rows: DataFrame, spec: Spec) -> DataFrame:
    """One row: id figures, flags, sums, shares and length structs."""
    read = rows.withColumns(spec.derived) if spec.derived else rows
    cols = {f"f_{k}": F.coalesce(c, F.lit(False)) for k, c in spec.flags.items()} | {f"s_{k}": F.coalesce(c, F.lit(0)).cast("long") for k, c in spec.sums.items()}
    cols |= {f"l_{k}": c.cast("long") for k, c in spec.lengths.items()}
    read = read.select(F.get_json_object("raw", "$.id").alias("id"), *(c.alias(k) for k, c in cols.items()), *(F.transform(c, lambda x: x.cast("long")).alias(f"m_{k}") for k, c in spec.many.items()))
    n = F.count("*")
    count = lambda k: F.count_if(f"f_{k}") if k in spec.flags else F.coalesce(F.sum(f"s_{k}"), F.lit(0))
    pct = lambda k, of: F.coalesce(F.try_divide(count(k) * 100.0, of), F.lit(0.0)).alias(f"{k}_pct")
    out = [n.alias("rows"), F.count("id").alias("ids"), F.count_distinct("id").alias("unique_ids"), (n - F.count("id")).alias("missing_id"), (F.count("id") - F.count_distinct("id")).alias("duplicate_ids")]
    out += [count(k).alias(k) for k in (*spec.flags, *spec.sums)] + [pct(k, n) for k in spec.shares]
    if "special_stepwise_samples" in spec.sums:
        out.append(pct("special_stepwise_samples", F.coalesce(F.sum("s_total_steps"), F.lit(0))))
    # Exact percentiles keep a value's frequency, not its rows, so they are as large as the distinct lengths.
    out += [F.struct(*length_stats(f"l_{k}")).alias(k) for k in spec.lengths]
    whole = read.agg(*out)
    for k in spec.many:
        one = read.select(F.explode(f"m_{k}").alias("v")).agg(F.struct(*length_stats("v")).alias(k))
        whole = whole.crossJoin(one)  # one row each
    return whole


def report(rows: DataFrame, file_type: str, intents: list[str] = (), order: str = "row_idx", most: int = 1000) -> dict:
    """All figures and, in order of frequency, the ``most`` most frequent values of each counter; OTHERS counts the rest."""
    spec = spec_of(file_type, list(intents))
    out = figures(rows, spec).first().asDict(recursive=True)
    if spec.counts:
        full = counters(rows, spec, order).where("n > 0 or counter = 'prompt_sections'")
        nth = F.row_number().over(Window.partitionBy("counter").orderBy(F.desc("n"), "first", "value"))
        for r in full.withColumn("k", nth).where(F.col("k") <= most).orderBy("counter", "k").collect():
            out.setdefault(r["counter"], {})[r["value"]] = r["n"]
        if any(isinstance(v, dict) and len(v) >= most for v in out.values()):
            for r in full.groupBy("counter").agg(F.sum("n").alias("n")).collect():  # one row a counter
                rest = r["n"] - sum(out[r["counter"]].values())
                if rest:
                    out[r["counter"]][OTHERS] = rest
    return out


# Text of the report. Numbers are formatted by Python, whose rounding readers know.


def _share(x) -> str:
    return f"{float(x or 0):.2f}%"


# What a report says first, by type of file. Names ending in _pct are shares; a dot leads into a figure's parts.
HIGHLIGHTS = {
    "planner_trajectory": (
        "轨迹 {rows} 条，预计 step-wise SFT {estimated_stepwise_samples} 条，平均轨迹长度 {trajectory_length.avg:.2f}。",
        "特殊轨迹占 {special_trajectory_rows_pct}，但转换后特殊 step 只占 {special_stepwise_samples_pct}。",
        "工具调用轨迹占 {rows_with_tool_call_pct}，无工具轨迹占 {rows_with_no_tools_pct}。",
        "最终动作：planning_finish={final_action.planning_finish}，ask_clarification={final_action.ask_clarification}。",
        "风险计数：重复 id={duplicate_ids}，raw_content 空工具调用轨迹={rows_with_raw_empty_tool_call}，expected intent 冲突={rows_with_expected_intent_conflict}，forbidden tool={rows_with_forbidden_tool_call}。",
    ),
    "executor_answer_sft": (
        "执行阶段样本 {rows} 条，外部参考覆盖 {rows_with_external_info_pct}，追问建议覆盖 {rows_with_clarification_ask_pct}。",
        "平均回答长度 {answer_chars.avg:.0f} 字，平均外部参考长度 {external_info_chars.avg:.0f} 字。",
        "工具错误样本={rows_with_tool_error}，写文件计划={rows_with_file_write_plan}，实际写文件={rows_file_written}。",
    ),
    "message_sft": (
        "step-wise 样本 {rows} 条，含 reasoning {rows_with_reasoning_pct}，含工具消息 {rows_with_tool_messages_pct}。",
        "平均 messages 数 {message_count.avg:.2f}，平均 assistant 文本 {assistant_content_chars.avg:.0f} 字。",
    ),
    "final_prompt": (
        "最终 prompt 样本 {rows} 条，含 reasoning {rows_with_reasoning_pct}，含工具 schema {rows_with_tool_schema_pct}。",
        "平均 prompt 长度 {prompt_chars.avg:.0f} 字，平均 assistant 轮数 {assistant_turns.avg:.2f}。",
        "merge_source：planner_final={merge_source.planner_final}，executor_answer={merge_source.executor_answer}。",
        "intent 覆盖率 {rows_with_nonempty_intent_pct}，answer_template_intent 覆盖率 {rows_with_nonempty_answer_template_intent_pct}。",
    ),
    "": ("JSON 样本 {rows} 条，重复 id={duplicate_ids}，无效行={invalid_lines}。",),
}
_SAME = {"planner_step_sft": "message_sft", "merged_final_prompt": "final_prompt"}
_PLACE = re.compile(r"\{([\w.]+)(?::([^}]*))?\}")


def highlights(file_type: str, stats: dict, invalid_lines: int = 0) -> list[str]:
    """The sentences of a type, with its figures; what wasn't counted is 0."""

    def figure(place: re.Match) -> str:
        value = stats | {"invalid_lines": invalid_lines}
        for part in place[1].split("."):
            value = (value or {}).get(part)
        return _share(value) if place[1].endswith("_pct") else format(value or 0, place[2] or "")

    return [_PLACE.sub(figure, s) for s in HIGHLIGHTS.get(_SAME.get(file_type, file_type), HIGHLIGHTS[""])]


# The sentences below, their severities and limits.
def issues(file_type: str, stats: dict, invalid_lines: int = 0) -> list[tuple[str, str]]:
    """(severity, what) of the rules that hold."""
    found = []
    duplicates = stats.get("duplicate_ids") or 0

    def tell(test, level: str, words: str) -> None:
        if test:
            found.append((level, words))

    tell(invalid_lines, "高", f"存在 {invalid_lines} 行无效 JSON，会影响下游读取。")
    tell(duplicates, "中", f"存在 {duplicates} 个重复 id，断点续跑/去重可能跳样本。")
    if file_type == "planner_trajectory":
        steps, rows = stats["special_stepwise_samples_pct"], stats["special_trajectory_rows_pct"]
        raw, clash, bad, final = (stats["rows_with_raw_empty_tool_call"], stats["rows_with_expected_intent_conflict"], stats["rows_with_forbidden_tool_call"], stats.get("final_action", {}).get("tool_call", 0))
        tell(steps < 25, "中", f"特殊场景轨迹占 {_share(rows)}，但 step-wise 只占 {_share(steps)}，无工具/无关工具训练信号可能偏弱。")
        tell(steps > 45, "低", f"特殊场景 step-wise 占 {_share(steps)}，可能让模型偏保守。")
        tell(raw, "中", f"仍有 {raw} 条轨迹包含 raw_content 为空的工具调用 step；若已回填可忽略，否则会污染 intent。")
        tell(clash, "低", f"有 {clash} 条轨迹 content intent 与 expected_intent 不一致，需要抽样确认是否为标注或模型判断差异。")
        tell(bad, "高", f"存在 {bad} 条轨迹调用规划阶段禁用工具。")
        tell(final, "高", f"存在 {final} 条轨迹最终动作仍是 tool_call，规划未闭环。")
    if file_type == "executor_answer_sft":
        average = stats["answer_chars"]["avg"]
        tell(average < 200, "低", f"平均回答长度 {average:.0f} 字，可能偏短。")
        tell(stats["rows_with_external_info_pct"] < 50, "中", f"外部参考覆盖率仅 {_share(stats['rows_with_external_info_pct'])}。")
    if file_type == "merged_final_prompt":
        missing = stats.get("effective_intent", {}).get(MISSING, 0)
        tell(missing, "中", f"仍有 {missing} 条样本无法从 metadata 或 prompt 推断意图。")
        tell(stats["rows_with_tool_error"], "低", f"包含 {stats['rows_with_tool_error']} 条工具错误样本，确认是否是期望保留的鲁棒性数据。")
        tell(stats["rows_with_clarification_ask"], "低", f"包含 {stats['rows_with_clarification_ask']} 条澄清追问样本，应确认训练目标包含 ask 场景。")
    return found


def _meter(share: float, width: int = 20) -> str:
    full = max(0, min(width, round(share * width / 100)))
    return "█" * full + "░" * (width - full)


def markdown(name: str, file_type: str, stats: dict, invalid_lines: int = 0, limit: int = 8, detail: bool = True) -> str:
    """A report: highlights and issues, distributions with meters, and with ``detail`` all figures and lengths."""
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", "<br>")
    table = lambda head, rows: ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""]
    plain = [(k, _share(v) if k.endswith("_pct") else v) for k, v in stats.items() if not isinstance(v, dict)]
    lengths = [(k, *(f"{v[f]:.2f}" if f == "avg" else v[f] for f in ("count", "min", "avg", "p50", "p90", "p95", "p99", "max"))) for k, v in stats.items() if isinstance(v, dict) and "p50" in v]
    out = [f"# {name}（{file_type}）", "", "## 重点摘要", "", *(f"- {h}" for h in highlights(file_type, stats, invalid_lines)), ""]
    out += table(("figure", "value"), plain) if detail else []
    if lengths and detail:
        out += ["## lengths", "", *table(("field", "count", "min", "avg", "p50", "p90", "p95", "p99", "max"), lengths)]
    for k, v in stats.items():
        if isinstance(v, dict) and "p50" not in v and v:
            total = sum(v.values()) or 1
            out += [f"### {k}", "", *table(("类别", "数量", "占比", "分布"), [(a, b, _share(100 * b / total), _meter(100 * b / total)) for a, b in list(v.items())[:limit]])]
    told = issues(file_type, stats, invalid_lines)
    return "\n".join(out + (["## issues", "", *(f"- {level}: {words}" for level, words in told), ""] if told else []))
