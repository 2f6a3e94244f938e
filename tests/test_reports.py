"""Typed reports, tools, prompts, teachers: small rows with known figures."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltmill.functions import prompts, tools, validation
from siltmill.functions.lookups import HEALTH, Domain, irrelevant_tools
from siltmill.operators import ablation, reports, teacher


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def rows_of(spark, items):
    return spark.createDataFrame([(i, json.dumps(x, ensure_ascii=False)) for i, x in enumerate(items)], "row_idx int, raw string")


lit = F.lit
TRAJECTORIES = [
    {
        "id": "a", "user_query": "four", "scenario": "s", "tool_sampling_mode": "no_tools", "tools": [], "tool_failure_count": 2,
        "trajectory": [
            {"step": 1, "planner_output": {"intent": "x", "action": "tool_call", "tool_calls": [{"name": "search_web"}, {"name": "write_file"}]}, "planner_raw_output": {"raw_content": " "}, "observations": [{"name": "search_web", "content": "12345", "error": True}]},
            "bad",
            {"step": 2, "planner_output": {"action": "planning_finish"}, "planner_overridden": True, "intent_diagnostics": {"expected_intent_conflict": True}},
        ],
    },
    {"id": "a", "user_query": None, "expected_intent": "y", "tools": [{"function": {"name": "t"}}], "trajectory": [{"planner_output": {"action": "tool_call", "tool_call": {"name": "t"}}, "observation": {"content": "1"}}]},
    {"user_query": "q", "trajectory": None},
]


def test_values_beyond_the_limit_are_counted_together(spark):
    rows = rows_of(spark, [{"id": str(i), "user_query": "q", "scenario": f"s{i % 5}"} for i in range(12)])
    got = reports.report(rows, "seed", most=2)["scenario"]
    assert got == {"s0": 3, "s1": 3, reports.OTHERS: 6} and reports.OTHERS not in reports.report(rows, "seed")["scenario"]


def test_highlights():
    stats = {"rows": 3, "answer_chars": {"avg": 12.6}, "external_info_chars": {"avg": 0}, "rows_with_external_info_pct": 33.333, "rows_with_tool_error": 2, "duplicate_ids": 1}
    assert reports.highlights("executor_answer_sft", stats) == ["执行阶段样本 3 条，外部参考覆盖 33.33%，追问建议覆盖 0.00%。", "平均回答长度 13 字，平均外部参考长度 0 字。", "工具错误样本=2，写文件计划=0，实际写文件=0。"]
    assert reports.highlights("seed", stats, 4) == ["JSON 样本 3 条，重复 id=1，无效行=4。"]
    assert [len(reports.highlights(k, {})) for k in ("planner_trajectory", "planner_step_sft", "message_sft", "final_prompt", "merged_final_prompt")] == [5, 2, 2, 4, 4]
    assert "## 重点摘要" in reports.markdown("x", "seed", stats) and "## lengths" not in reports.markdown("x", "seed", stats, detail=False)


def test_trajectory_report(spark):
    got = reports.report(rows_of(spark, TRAJECTORIES), "planner_trajectory")
    want = {
        "rows": 3, "ids": 2, "unique_ids": 1, "missing_id": 1, "duplicate_ids": 1, "total_steps": 4, "total_tool_calls": 3, "rows_with_tool_call": 2, "rows_with_search_tool_call": 1, "rows_with_no_tools": 2,
        "rows_with_tool_error": 1, "rows_with_injected_failure": 1, "rows_with_ask": 0, "rows_with_overridden": 1, "rows_with_raw_empty_tool_call": 2, "rows_with_forbidden_tool_call": 1,
        "rows_with_expected_intent_conflict": 1, "rows_with_reasoning_content_conflict": 0, "malformed_steps": 1, "missing_final": 1, "special_trajectory_rows": 1, "special_stepwise_samples": 3, "special_stepwise_samples_pct": 75.0,
    }
    assert {k: got[k] for k in want} == want
    assert got["scenario"] == {"(missing)": 2, "s": 1} and list(got["scenario"]) == ["(missing)", "s"]
    assert got["steps_by_sampling_mode"] == {"no_tools": 3, "(missing)": 1} and got["tool_calls_by_sampling_mode"] == {"no_tools": 2, "(missing)": 1}
    assert got["step_action"] == {"tool_call": 2, "planning_finish": 1} and got["final_action"] == {"planning_finish": 1, "tool_call": 1}
    assert got["tool_calls_by_name"] == {"search_web": 1, "write_file": 1, "t": 1} and got["exposed_tools"] == {"t": 1}
    assert got["observation_chars"] == {"count": 2, "min": 1, "max": 5, "avg": 3.0, "p50": 1, "p90": 5, "p95": 5, "p99": 5}
    assert got["trajectory_length"]["max"] == 3 and got["query_length"]["max"] == 4
    levels = [level for level, _ in reports.issues("planner_trajectory", got, 2)]
    assert levels == ["高", "中", "低", "中", "低", "高", "高"]
    assert "## issues" in reports.markdown("x", "planner_trajectory", got)


def test_message_and_executor_report(spark):
    said = {"role": "assistant", "content": "<think>a</think>b", "tool_calls": [{"function": {"name": "write_file"}}]}
    items = [
        {"id": 1, "messages": [{"role": "user", "content": "hi"}, said, {"role": "tool", "content": None}, 3], "metadata": {"action": "x", "source_id": "s", "has_tool_error": True, "tool_names": ["t", "t"]}, "tools": [{"function": {"name": "t"}}],
         "executor_raw_output": {"content": "abc"}, "external_info": "无外部补充信息。", "clarification_ask": ""},
        {"id": 2, "messages": None, "external_info": " i ", "file_write_plan": {}},
    ]
    got = reports.report(rows_of(spark, items), "executor_answer_sft")
    assert got["message_roles"] == {"user": 1, "assistant": 1, "tool": 1} and got["source"] == {"s": 1, "(missing)": 1}
    assert (got["message_count"]["max"], got["message_content_chars"]["max"], got["assistant_content_chars"]["count"]) == (4, 19, 1)
    assert (got["rows_with_exposed_tools"], got["rows_with_tool_messages"], got["rows_with_reasoning"], got["rows_with_forbidden_tool_call"]) == (1, 1, 1, 1)
    assert (got["rows_with_external_info"], got["rows_with_external_info_pct"], got["rows_with_clarification_ask"], got["rows_with_file_write_plan"], got["rows_with_tool_error"]) == (1, 50.0, 1, 1, 1)
    assert got["tool_names"] == {"t": 2} and got["answer_chars"]["max"] == 3


def test_prompt_and_seed_report(spark):
    p = '# Tools<|im_start|>user\nx<|im_end|><|im_start|>assistant\n<think>q</think>{"intent": "其他", "action": "planning_finish"}<|im_end|>'
    items = [
        {"id": "1", "prompt": p, "metadata": {"merge_source": "planner_final", "tool_names": "a, b", "has_tool_error": "no"}},
        {"id": "2", "prompt": "", "metadata": {"merge_source": "executor_answer", "answer_template_intent": "k", "tool_names": ["a"], "has_clarification_ask": False}},
    ]
    got = reports.report(rows_of(spark, items), "merged_final_prompt", HEALTH.intents)
    assert got["effective_intent"] == {"其他": 1, "k": 1} and got["metadata_intent"] == {"(missing)": 2} and got["planner_final_intent"] == {"其他": 1}
    assert got["has_tool_error"] == {"True": 1, "False": 1} and got["tool_names"] == {"a": 2, "b": 1} and got["inferred_final_action"] == {"planning_finish": 1, "unknown": 1}
    assert got["prompt_sections"]["has_think"] == 1 and got["prompt_sections"]["has_tool"] == 0 and got["rows_with_tool_schema_pct"] == 50.0
    assert got["assistant_turns"]["max"] == 1 and got["prompt_chars"]["max"] == len(p)
    seed = reports.report(rows_of(spark, [{"id": 1, "user_query": "abc", "rag_summary": " "}, {"id": 2, "rag_summary": "x"}]), "seed")
    assert seed["rag_summary_present_pct"] == 50.0 and seed["expected_intent"] == {"": 2}
    assert reports.report(rows_of(spark, [{}]).limit(0), "seed")["query_length"] == dict.fromkeys(("count", "min", "max", "p50", "p90", "p95", "p99"), 0) | {"avg": 0.0}


def test_validation(spark):
    ok = lambda c: value(spark, c)
    long = "名字 团队 " + "x" * 120
    assert ok(validation.identity_answer(lit("你好吗？"), lit(long), lit("r"), "名字", "团队")) is None
    assert ok(validation.identity_answer(lit("你好吗？"), lit("x" * 120), lit("r"), "名 字", "团队")) == "missing_name"
    assert ok(validation.identity_answer(lit("abc"), lit(long), lit("r"), "名字", "团队")) == "user_query_length=3"
    assert ok(validation.identity_answer(lit("你好吗？"), lit(long + "我是Qwen"), lit("r"), "名字", "团队")) == "forbidden_phrase"
    assert ok(validation.identity_plan(lit("你好吗？"), lit("r" * 40))) == "reasoning_missing_finish_signal"
    assert ok(validation.no_intent_answer(lit("y" * 80), lit("回答模板"))) == "leak_hidden_field_phrase" and ok(validation.no_intent_answer(lit("y"), lit(None))) == "answer_too_short=1"


def test_tools(spark):
    j = lambda **k: lit(json.dumps(k, ensure_ascii=False))
    assert value(spark, tools.calculate_bmi(j(height_cm=170, weight_kg="65"))) == "BMI=22.5，中国成人参考分类：正常。"
    assert value(spark, tools.calculate_bmi(j(height_cm="x"))) == tools.BMI_BAD
    assert value(spark, tools.calculate_daily_water(j(weight_kg=60, activity_level="HIGH"))).startswith("按 40 ml/kg 估算，每日饮水量约 2400 ml。")
    assert value(spark, tools.calculate_heart_rate(j(age=30))) == "估算最大心率 190 次/分；moderate 强度目标心率约 114-143 次/分。"
    assert value(spark, tools.calculate_heart_rate(j(age=0))) == tools.HEART_BAD
    assert "订单 7 " in value(spark, tools.customer_service("lookup_order_status", j(), lit("7"), lit(None)))
    assert "未注册" not in value(spark, tools.health_talent("recommend_training_tasks", j(), lit("t"), lit(None), lit(None)))
    assert value(spark, tools.search_rag(j(query=" q "), lit(" "))) == "未检索到相关内容。检索语句：q"
    assert value(spark, tools.safe_file_name(lit("../a b?.md"))) == "a_b_.md" and value(spark, tools.safe_file_name(lit("x.pdf"))) == "x.pdf.md" and value(spark, tools.safe_file_name(lit(None))) == tools.PLAN_FILE_NAME
    assert value(spark, tools.mock("t", j(a=1), "got {a} and {b}")) == "got 1 and {b}" and value(spark, tools.mock("t", j(a=1))) == "（模拟结果）t 已执行：a=1"
    n = value(spark, tools.random_number(j(min_value=9, max_value=3), lit("k"), 1))
    assert 3 <= int(n.split("=")[1].split("，")[0]) <= 9


def test_tool_sets(spark):
    names = ["a", "b", "c", "d", "e"]
    none = F.array().cast("array<string>")
    base = spark.range(300).withColumn("k", F.col("id").cast("string"))
    show = lambda **o: [r.t for r in base.select(tools.expose(names, o.get("fixed", none), lit(o.get("mode", "normal")), o.get("required", none), F.array(lit("d"), lit("e")), F.col("k"), 3, most=3, wanted=o.get("wanted")).alias("t")).collect()]
    normal = show(required=F.array(lit("c")))
    assert all("c" in t and 1 <= len(t) <= 3 and len(set(t)) == len(t) for t in normal) and len({len(t) for t in normal}) == 3
    assert all(t == [] for t in show(mode="no_tools")) and all(1 <= len(t) <= 2 and set(t) <= {"d", "e"} for t in show(mode="irrelevant_tools"))
    assert show(fixed=F.array(lit("b"), lit("z"), lit("b")))[0] == ["b"] and {len(t) for t in show(wanted=lit(9))} == {3}
    domain = Domain(tools=("a", "b", "g"), generic_tools=("g",))
    assert value(spark, irrelevant_tools(domain, F.array(lit("a")), none)) == ["b"] and value(spark, irrelevant_tools(domain, F.array(lit("a"), lit("b")), F.array(lit("a")))) == ["b", "g"]
    calls = F.array(*(F.struct(lit(f"i{k}").alias("id"), lit("ab"[k % 2]).alias("name")) for k in range(6)))
    got = value(spark, tools.failing_calls(calls, "a", 2, lit("k"), 1))
    assert len(got) == 2 and set(got) <= {"i0", "i2", "i4"} and value(spark, tools.failing_calls(calls, "", 0, lit("k"), 1)) == []


def test_prompts(spark):
    d = Domain(intents=("运动指导", "其他"), aliases={"功法": "运动指导"}, default_intent="其他", tool_hints={"t": "运动指导"})
    assert prompts.intent_in("用户意图是“其他”，更可能属于运动指导类", d) == "运动指导"
    assert prompts.intent_in("这不属于运动指导类", d) is None and prompts.intent_in("练功法", d) == "运动指导" and prompts.intent_in(None, d) is None
    got = value(spark, prompts.infer_intent(lit("?"), lit(None), lit(""), F.array(lit("t")), lit(None), d))
    assert got == "运动指导"
    body = value(spark, prompts.executor_content(lit(" q "), lit("i"), lit(None), lit(""), lit(" "), lit(None), lit("r")))
    assert body == "【用户问题】\nq\n\n【识别意图】\ni\n\n【回答建议】\n无特定回答模板，请按通用要求作答。\n\n【外部参考信息】\n无外部补充信息。\n\n【近期历史对话】\nr"
    assert value(spark, prompts.planner_content(lit("q"), lit("i"), lit(None), lit(None))).startswith("q\n\n【参考意图】\ni\n请优先")


def test_ablation_rows(spark):
    rows = spark.createDataFrame([("1", "s", " q ", "i", " ", "r", " a "), ("2", "", "q", "i", "x", None, " "), ("3", "", "", "i", "x", None, "a")], "id string, source_id string, user_query string, intent string, external_info string, reasoning_content string, content string")
    got = ablation.copy_rows(rows, "sys", reasoning=True).collect()
    assert [r.id for r in got] == ["1_no_intent"] and got[0].messages[2].content == "<think>\nr\n</think>\na" and "无外部补充信息。" in got[0].messages[1].content
    assert ablation.copy_rows(rows, "sys", require_info=True).count() == 0


def test_teacher(spark):
    def answer(request):
        if request["n"] == 3:
            raise ValueError("no")
        return {"twice": request["n"] * 2}

    rows = spark.range(5).select("id", F.to_json(F.struct(F.col("id").alias("n"))).alias("request"))
    got = {r.id: (r.answer, r.error) for r in teacher.ask(rows, "request", answer, retries=1).collect()}
    assert got[2] == ('{"twice": 4}', None) and got[3] == (None, "ValueError: no")
    waits = []
    assert teacher.call(answer, {"n": 3}, 3, waits.append) == (None, "ValueError: no") and waits == [2.0, 3.0]
    with pytest.raises(teacher.Fatal):
        teacher.call(lambda r: (_ for _ in ()).throw(teacher.Fatal("quota")), {})
    seeds = spark.createDataFrame([("a", "hello"), ("b", "")], "id string, user_query string")
    plan = lambda r: {"text": "re " + r["query"]}
    talk = {r.id: json.loads(r.turns) for r in teacher.converse(seeds, plan, lambda s: {"continue": False}, lambda t: "short", max_turns=4, min_turns=2).collect()}
    assert [t["user"] for t in talk["a"]] == ["hello", teacher.fallback_question("", 1)] and talk["b"] == []
    more = teacher.converse(seeds, plan, lambda s: {"continue": True, "user_query": f"more {s['turn']}"}, lambda t: f"{len(t)} chars", max_turns=5, recent=2, every=2).collect()
    assert Counter(len(json.loads(r.turns)) for r in more) == {5: 1, 0: 1} and more[0].compressed.endswith("chars")


def test_artifacts(spark, tmp_path):
    from siltmill.sources import artifacts

    assert artifacts.classify("x_multiturn_planner_trajectories.jsonl") == ("x", "multiturn_planner_trajectories.jsonl")
    assert artifacts.classify("a_b_duplicates.jsonl.bak_2") == ("a_b", "duplicates.jsonl.bak_2") and artifacts.classify("final.jsonl") is None
    assert artifacts.key_of("data_stats.md") == "data_stats_md" and artifacts.default_prefix(" a b ") == "a_b_train"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "t_duplicates.jsonl").write_text("x")
    root = f"file://{tmp_path}"
    assert artifacts.artifact_path(spark, root, "duplicates", "d", "t") == f"{root}/d/t_duplicates.jsonl"
    assert artifacts.artifact_path(spark, root, "identity_sft", "d", "t") == f"{root}/d/t/identity_sft.jsonl"
    got = artifacts.inventory(spark, f"{root}/d").first()
    assert (got.task, got.files, got.bytes, got.names) == ("d", 1, 1, ["t_duplicates.jsonl"])
    runs = spark.createDataFrame([("1", 1, "a", 5, 5), ("1", 2, "b", 5, 5), ("2", 1, "c", None, 9)], "id string, n int, status string, startedAt int, createdAt int")
    assert [(r.id, r.status) for r in artifacts.latest_runs(runs, "n").collect()] == [("2", "c"), ("1", "b")]
    old, new = (spark.createDataFrame(x, "path string, length long") for x in ([("a", 1), ("b", 2)], [("b", 5), ("c", 1)]))
    assert {r.path: (r.status, r.grown) for r in artifacts.changed_files(old, new).collect()} == {"a": ("removed", -1), "b": ("changed", 3), "c": ("added", 1)}
