"""Stages from files to files."""

import json

import pytest

from siltmill.__main__ import _value
from siltmill.plans import stages
from siltmill.sources import jsonl


@pytest.fixture
def put(tmp_path):
    def write(name, rows):
        lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
        (tmp_path / name).write_text("\n".join(lines), encoding="utf-8")
        return f"file://{tmp_path}/{name}"

    return write


def read(spark, path):
    return [json.loads(r.raw) for r in jsonl.lines(spark, path).orderBy("row_idx").collect()]


def prompt(user, answer):
    return f"<|im_start|>user\n{user}<|im_end|>\n<|im_start|>assistant\n<think>t</think>{answer}<|im_end|>\n"


def test_dedup_stage(spark, put, tmp_path):
    rows = [
        {"id": "1", "prompt": prompt("one question here", "the same answer text"), "metadata": {"merge_source": "planner_final"}}, "oops",
        {"id": "2", "prompt": prompt("another thing asked", "The same answer, text!"), "metadata": {"merge_source": "planner_final"}},
        {"id": "3", "prompt": prompt("yet another question", "the same answer text"), "metadata": {"merge_source": "executor_answer"}},
        {"id": "4", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "something entirely different"}]},
    ]
    out = f"file://{tmp_path}/out"
    stats = stages.dedup_final_prompt(spark, put("in.jsonl", rows), out, duplicates=f"file://{tmp_path}/log", keep="first")
    assert (stats["input_rows"], stats["output_rows"], stats["invalid_rows"]) == (4, 3, 1)
    assert [r["id"] for r in read(spark, out)] == ["1", "3", "4"]
    assert read(spark, f"file://{tmp_path}/log")[0]["cluster_size"] == 2
    assert stages.dedup_final_prompt(spark, put("in.jsonl", rows), out, dedup_key="user", dry_run=True)["output_rows"] == 4


def test_dedup_stage_logs_every_removed_row(spark, put, tmp_path):
    rows = [{"id": str(i), "prompt": prompt("one question here", "the same answer text " * 20), "metadata": {"merge_source": "planner_final"}} for i in range(2105)]
    stages.dedup_final_prompt(spark, put("in.jsonl", rows), f"file://{tmp_path}/out", duplicates=f"file://{tmp_path}/log", keep="first")
    log = sorted(read(spark, f"file://{tmp_path}/log"), key=lambda r: r["part"])
    gone = [x for r in log for x in r["removed_records"]]
    assert [r["part"] for r in log] == [0, 1, 2] and {r["removed"] for r in log} == {2104}
    assert [json.loads(x["data"]) for x in gone] == rows[1:] and json.loads(log[0]["kept"]["data"]) == rows[0]
    assert {len(x["text_preview"]) for x in gone} == {300}


def test_reviewed_rows_are_split(spark, put, tmp_path):
    sources = {"k1": "executor_answer", "k2": "executor_answer", "k3": "planner_final", "k4": "planner_final", "k5": None}
    merged = put("m", [{"id": k, "metadata": {"merge_source": v}, "prompt": k * 2} for k, v in sources.items()])
    said = [("k4", "reject"), ("k1", "reject"), ("k2", "pass"), ("k1", "pass")]
    reviews = put("r", [{"id": f"{k}_reviewer", "source_id": k, "decision": d} for k, d in said] + ["", {"id": "nobody", "decision": "pass"}])
    ok, bad = f"file://{tmp_path}/ok", f"file://{tmp_path}/bad"
    assert stages.reviewed_final_prompt(spark, merged, reviews, ok, bad) == {"reviews": 3, "approved": 3, "rejected": 1, "unmatched": 1}
    assert [r["id"] for r in read(spark, ok)] == ["k1", "k2", "k3"]
    assert [(r["sample"]["prompt"], r["review"]["source_id"]) for r in read(spark, bad)] == [("k4k4", "k4")]
    with pytest.raises(ValueError):
        stages.reviewed_final_prompt(spark, put("n", [{"a": 1}]), reviews, ok, bad)


def test_merge_stage_appends_caps_and_reports_missing_inputs(spark, put, tmp_path):
    a = put("a", [{"text": "one"}, "", "oops", {"text": "two"}, "null", {"text": "three"}])
    b, gone, out = put("b", [{"text": "two"}, [1], {"text": "four"}]), f"file://{tmp_path}/none", f"file://{tmp_path}/out"
    found = stages.merge_tasks(spark, [a, gone, b], out, max_rows=1)
    assert [(p["read"], p["written"], p["duplicated"], p["invalid"], p["missing"]) for p in found["sources"]] == [(1, 1, 0, 0, False), (0, 0, 0, 0, True), (1, 1, 0, 0, False)]
    assert read(spark, out) == [{"text": "one"}, {"text": "two"}]  # what the cap left unread takes no signature
    found = stages.merge_tasks(spark, [a, gone, b], out, max_rows=2)
    assert [(p["read"], p["written"], p["duplicated"], p["invalid"]) for p in found["sources"]] == [(5, 1, 2, 2), (0, 0, 0, 0), (2, 1, 1, 0)]
    assert (found["before"], found["after"]) == (2, 4) and sorted(map(str, read(spark, out))) == sorted(map(str, [{"text": "one"}, {"text": "two"}, {"text": "three"}, [1]]))
    again = stages.merge_tasks(spark, [a, b], out, force_rebuild=True)
    assert (again["before"], again["written"], again["after"]) == (0, 5, 5)
    assert stages.merge_tasks(spark, [b, b], out, dedup_by="none")["written"] == 6


def test_step_samples_carry_the_exposed_tools(spark, put, tmp_path):
    tool = lambda n: {"type": "function", "function": {"name": n, "parameters": {"type": "object"}}}
    final = {"step": 1, "planner_output": {"intent": "其他", "action": "planning_finish", "finish_reason": "ok"}}
    rows = [{"id": "a", "tools": [tool("search"), tool("write_file")]}, {"id": "b"}, {"id": "c", "tools": []}, {"id": "d", "tools": "none"}]
    path, out = put("t", [{**r, "user_query": "q", "trajectory": [final]} for r in rows]), f"file://{tmp_path}/out"
    assert stages.planner_step_sft(spark, path, out, "sys", catalog=json.dumps([tool("plan"), tool("write_file")])) == 4
    assert {r["id"]: r["tools"] for r in read(spark, out)} == {"a_step_1": [tool("search")], "b_step_1": [tool("plan")], "c_step_1": [], "d_step_1": []}


def test_fixed_intents_reach_the_written_rows(spark, put, tmp_path):
    bad = {"step": 1, "planner_output": {"intent": "其他", "action": "tool_call", "tool_calls": [{"name": "t", "arguments": {"a": [1, 2]}}]}, "planner_raw_output": {"raw_content": " ", "reasoning_content": "why "}, "intent_diagnostics": {"reasoning_intent": "运动功法", "expected_intent": "食疗咨询"}}
    final = {"step": 2, "planner_output": {"intent": "运动功法", "action": "planning_finish", "finish_reason": "ok"}}
    rows = [{"id": "x", "deep": {"kept": [1.5, None]}, "trajectory": [bad, final]}, "", "oops", {"id": "y", "trajectory": [final]}, {"id": "z"}]
    path = put("t", rows)
    counts = stages.fix_intents(spark, path, in_place=True)
    assert (counts["total"], counts["json_rows"], counts["invalid"], counts["changed_rows"], counts["changed_steps"]) == (5, 3, 1, 1, 1)
    lines = [r.raw for r in jsonl.lines(spark, path).orderBy("row_idx").collect()]
    assert lines[1:3] == ["", "oops"] and [json.loads(x) for x in lines[3:]] == rows[3:]
    row, step = json.loads(lines[0]), json.loads(lines[0])["trajectory"][0]
    assert row["deep"] == rows[0]["deep"] and row["trajectory"][1] == final and step["planner_output"] == {**bad["planner_output"], "intent": "运动指导"}
    content = '{"intent": "运动指导", "action": "tool_call"}'
    assert step["planner_raw_output"] == {**bad["planner_raw_output"], "content": content, "normalized_content": content, "text": f"<think>\nwhy\n</think>\n{content}"}
    assert step["intent_diagnostics"] == {**bad["intent_diagnostics"], "content_intent": "运动指导", "reasoning_content_conflict": False, "expected_intent_conflict": True}
    assert row["metadata"] == {"empty_tool_call_intent_repaired": True, "empty_tool_call_intent_repaired_steps": 1} and row["empty_tool_call_intent_backfill_count"] == 1
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("t.bak_")]) == 1
    assert stages.fix_intents(spark, path)["changed_steps"] == 0


def test_final_prompts(spark, put, tmp_path):
    chat = lambda *said: [{"role": r, "content": c} for r, c in said]
    sft = put("s", [{"id": "a", "messages": chat(("system", "s"), ("user", "u")), "metadata": {"k": [1]}}, "", {"messages": chat(("user", "v"))}, {"id": "a", "messages": []}])
    out = f"file://{tmp_path}/planner"
    assert stages.planner_final_prompt(spark, sft, out) == {"added": 2, "skipped": 1}
    mark = lambda r, c: f"<|im_start|>{r}\n{c}<|im_end|>\n"
    assert read(spark, out) == [{"id": "a", "prompt": mark("system", "s") + mark("user", "u"), "metadata": {"k": [1]}}, {"id": "line_3", "prompt": mark("user", "v"), "metadata": {}}]
    assert stages.planner_final_prompt(spark, sft, out) == {"added": 0, "skipped": 3}
    executor = put("e", [
        {"id": "a", "messages": chat(("user", "dup"))}, {"id": "p", "source_id": 7, "domain": "shop", "intent": "buy", "messages": chat(("system", "old"), ("user", "u"))},
        {"domain": "elsewhere", "clarification_ask": "which?", "messages": chat(("user", "w")), "metadata": {"tool_names": ["x", "y"], "step": "3", "has_tool_error": 1}}, {"id": "q", "messages": []}, {"id": "r", "messages": chat(("user", "z"))},
    ])
    made = f"file://{tmp_path}/merged"
    counts = stages.merged_final_prompt(spark, out, executor, made, assembly={"shop": " house rules "}, max_executor_samples=2)
    assert counts == {"planner_added": 2, "planner_skipped": 0, "executor_added": 2, "executor_skipped": 1, "total_added": 4, "total_skipped": 1}
    rows = read(spark, made)
    assert [r["id"] for r in rows] == ["a", "line_3", "p", "executor_line_3"]
    assert [r["prompt"] for r in rows[2:]] == [mark("system", "house rules") + mark("user", "u"), mark("user", "w")]
    assert list(rows[0]["metadata"]) == list(rows[3]["metadata"]) and rows[0]["metadata"]["merge_source"] == "planner_final"
    want = {"merge_source": "executor_answer", "source_id": "7", "domain": "shop", "intent": "buy", "has_clarification_ask": False, "executor_assembly_system_prompt_source": "domain"}
    assert {k: rows[2]["metadata"][k] for k in want} == want
    want = {"domain": "health", "tool_names": "x,y", "step": 3, "has_tool_error": True, "has_clarification_ask": True, "executor_assembly_system_prompt_source": "executor_messages"}
    assert {k: rows[3]["metadata"][k] for k in want} == want
    assert stages.merged_final_prompt(spark, out, executor, made)["total_added"] == 1
    assert stages.merged_final_prompt(spark, f"file://{tmp_path}/none", executor, made, model_template=lambda m, t: f"{len(m)} {len(t)}", force_rebuild=True)["executor_added"] == 4
    assert read(spark, made)[1]["prompt"] == "2 0"
    with pytest.raises(ValueError):
        stages.planner_final_prompt(spark, put("w", ["[1]"]), out)


def test_executor_and_reviewer(spark, put, tmp_path):
    step = {"step": 1, "planner_output": {"intent": "运动功法", "action": "tool_call", "tool_call": {"name": "plan_write_file", "arguments": {"filename": "f.md"}}}, "observation": {"name": "t", "content": " seen ", "error": True}}
    ask = {"step": 2, "planner_output": {"action": "ask_clarification", "ask": " how? "}}
    rows = [
        {"id": 1, "user_query": " q1 ", "scenario": "s", "trajectory": [step, ask], "history": {"user_query": "before", "answer": "that"}, "history_summary": " sum ", "selected_tool_names": "t", "metadata": {"m": 1}},
        {"id": 2, "user_query": " "}, {"id": 3, "user_query": "q3"}, {"id": 4, "user_query": "fails"},
    ]

    def answer(request):
        if "fails" in request["messages"][1]["content"]:
            raise OSError("no answer")
        return {"reasoning_content": "r ", "content": f" {len(request['messages'])} said "}

    out = f"file://{tmp_path}/out"
    path = put("t", rows)
    assert stages.executor_answer(spark, path, out, answer, "sys", max_retries=1, plan_tools=("plan_write_file",)) == 2
    one, three = read(spark, out)
    assert [m["role"] for m in one["messages"]] == ["system", "user", "assistant"] and one["messages"][2]["content"] == one["executor_raw_output"]["text"] == "<think>\nr\n</think>\n2 said"
    want = {"id": "1_executor", "source_id": "1", "domain": "health", "user_query": "q1", "scenario": "s", "intent": "运动指导", "clarification_ask": "how?", "compressed_history_text": "sum", "recent_history_text": "用户：before\n助手：that"}
    assert {k: one[k] for k in want} == want and one["external_info"] == "【1. t（工具失败）】\nseen"
    assert one["file_write_plan"] == {"tool_name": "plan_write_file", "filename": "f.md", "file_type": "markdown", "write_purpose": "save final answer", "content_source": "executor_final_answer"}
    want = {"tool_names": ["t"], "fixed_tool_names": ["t"], "has_tool_error": True, "has_file_write_plan": True, "has_clarification_ask": True, "has_compressed_history": True, "has_recent_history": True, "source_metadata": {"m": 1}}
    assert {k: one["metadata"][k] for k in want} == want
    assert (three["intent"], three["external_info"], three["clarification_ask"], three["metadata"]["source_metadata"]) == ("其他", "无外部补充信息。", None, None)
    assert stages.executor_answer(spark, path, out, lambda r: {"content": "late"}, "sys") == 1

    def judge(request):
        good = "2 said" in request["messages"][1]["content"]
        body = {"decision": "pass", "score": 3 if good else 5, "issues": [{"type": " t ", "message": "m", "evidence": None}], "suggestions": [" do "]}
        return {"content": f"```json\n{json.dumps(body)}\n```"}

    reviews = f"file://{tmp_path}/reviews"
    assert stages.review_results(spark, out, reviews, judge, "sys", min_pass_score=4) == 3
    found = {r["id"]: r for r in read(spark, reviews)}
    assert {k: (r["decision"], r["score"], r["reviewer_raw_output"]["decision"]) for k, r in found.items()} == {"1_executor_reviewer": ("reject", 3, "pass"), "3_executor_reviewer": ("reject", 3, "pass"), "4_executor_reviewer": ("pass", 5, "pass")}
    first = found["1_executor_reviewer"]
    assert (first["source_sample_id"], first["role"], first["source_role"], first["issues"][0]["type"], first["suggestions"]) == ("1_executor", "reviewer", "executor", "t", ["do"])
    assert first["metadata"] == {"domain": "health", "user_query": "q1", "min_pass_score": 4, "reviewed_answer_chars": len(one["messages"][2]["content"])}
    assert stages.review_results(spark, out, reviews, judge, "sys") == 0
    for bad in ([{"user_query": "q"}], [{"id": 9, "messages": []}]):
        with pytest.raises(ValueError):
            stages.review_results(spark, put("bad", bad), f"file://{tmp_path}/b", judge, "sys")
    with pytest.raises(ValueError):
        stages.review_results(spark, out, f"file://{tmp_path}/c", lambda r: {"content": "pass"}, "sys", max_retries=2)


def test_merge_stats_and_steps(spark, put, tmp_path):
    a, b = put("a", [{"id": 1, "text": "x"}, "", "bad"]), put("b", [{"id": 2, "text": "x"}, {"id": 3, "text": "y"}])
    found = stages.merge_tasks(spark, [a, b], f"file://{tmp_path}/u", report=f"file://{tmp_path}/rep")
    assert (found["read"], found["written"], found["duplicated"], found["invalid"]) == (4, 2, 1, 1)
    step = {"step": 1, "planner_output": {"intent": "其他", "action": "tool_call", "tool_calls": [{"name": "t"}]}, "planner_raw_output": {"raw_content": ""}}
    final = {"step": 2, "planner_output": {"intent": "运动指导", "action": "planning_finish", "finish_reason": "ok"}}
    t = put("t", [{"id": "q", "user_query": "u", "tools": [], "trajectory": [step, final]}, "", {"id": "r", "trajectory": [final]}])
    made = json.loads(stages.data_stats(spark, [t], format="json"))[0]
    assert (made["file_type"], made["blank_lines"], made["stats"]["total_steps"]) == ("planner_trajectory", 1, 3)
    assert "特殊场景" in stages.data_stats(spark, [t])
    out = f"file://{tmp_path}/steps"
    assert stages.planner_step_sft(spark, t, out, "sys") == 3 and stages.planner_step_sft(spark, t, out, "sys") == 3
    assert stages.fix_intents(spark, t, f"file://{tmp_path}/fix")["changed_steps"] == 1 and stages.fix_intents(spark, t, "", domain=None, dry_run=True)["changed_rows"] == 0
    got = stages.downsample(spark, t, f"file://{tmp_path}/kept", "运动指导", 1, f"file://{tmp_path}/gone")
    assert got == {"rows": 2, "removed": 1} and len(read(spark, f"file://{tmp_path}/gone")) == 1
    answers = put("e", [{"id": "e", "user_query": "q", "executor_raw_output": {"content": "a"}}, {"id": "f", "user_query": "q"}])
    assert stages.no_intent_executor(spark, answers, f"file://{tmp_path}/ne", "sys") == 1


def test_argument_values():
    assert _value(int | None, "3") == 3 and _value(float, "0.5") == 0.5 and _value(bool, "true") is True and _value(list[str], "a,b") == ["a", "b"] and _value(str | None, "x") == "x"
