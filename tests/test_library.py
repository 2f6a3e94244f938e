"""The engine's own operators: golden facts, awkward rows, and every query against its SQL."""

import json
import random

import pytest
from pyspark.sql import functions as F

from siltmill.functions import jsonx, lookups, nested, numbers, text
from siltmill.operators import dedup, merge, review, roles, sampling, sessions, steps
from siltmill.operators.components import connected_components
from siltmill.sources import jsonl, sinks
from siltmill.streaming import incremental


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(x):
    return F.lit(x)


# Review protocol


def test_review_split_takes_the_last_review_of_a_sample(spark):
    merged = [("s1", "executor_answer"), ("s2", "executor_answer"), ("s3", None), ("s4", "executor_answer"), ("s5", "planner_final"), ("s6", "planner_final")]
    said = [("s1", "pass", 4), ("s1", "reject", 9), ("s2", "reject", 1), ("s2", "pass", 2), ("s3", "pass", 3), ("s6", "reject", 5), ("", "pass", 6), ("gone", "pass", 7)]
    merged = spark.createDataFrame(merged, "id string, merge_source string")
    reviews = spark.createDataFrame(said, "source_sample_id string, decision string, row_idx int")
    out = review.split(merged, reviews)
    assert {r.id: r.outcome for r in out.collect()} == {"s1": "rejected", "s2": "approved", "s3": "approved", "s4": "unmatched", "s5": "approved", "s6": "rejected"}
    assert review.split_stats(out, reviews).first().asDict() == {"reviews": 5, "approved": 3, "rejected": 2, "unmatched": 1}


@pytest.mark.parametrize(
    ("row", "problem"),
    [
        ({"decision": "pass", "score": 5, "issues": [], "suggestions": []}, None),
        ({"decision": "通过", "score": 5, "issues": [], "suggestions": []}, "decision"),
        ({"decision": "pass", "score": 6, "issues": [], "suggestions": []}, "score"),
        ({"decision": "pass", "score": True, "issues": [], "suggestions": []}, "score"),
        ({"decision": "reject", "score": 1, "issues": "x", "suggestions": []}, "issues"),
        ({"decision": "reject", "score": 1, "issues": [{"type": "a", "message": " "}], "suggestions": []}, "issue"),
        ({"decision": "reject", "score": 1, "issues": [{"type": "a", "message": "b", "evidence": "c"}], "suggestions": ["d"]}, None),
        ({"decision": "reject", "score": 1, "issues": [], "suggestions": [1]}, "suggestion"),
        ([1], "not an object"),
    ],
)
def test_review_protocol(spark, row, problem):
    assert value(spark, jsonx.review_problem(jsonx.parsed(lit(json.dumps(row, ensure_ascii=False))))) == problem


def test_json_extraction(spark):
    bare, fenced, prose = '{"a": 1}', '```json\n{"a": 1}\n```', 'well {"a": 1} so'
    strict = lambda t: value(spark, F.to_json(jsonx.strict_object(lit(t))))
    loose = lambda t: value(spark, F.to_json(jsonx.lenient_object(lit(t))))
    assert strict(bare) == strict(fenced) == loose(prose) == loose(bare) == '{"a":1}'
    assert strict(prose) is None and loose("none") is None and strict("[1]") is None
    assert value(spark, jsonx.arguments(lit("plain"))) == '{"query":"plain"}'


# Text


def test_text_functions(spark):
    assert value(spark, text.normalize(lit("Éa-B 中文!１2"))) == "aB中文2".lower()
    assert value(spark, F.size(text.char_ngrams(lit("ab"), 3))) == 0
    assert sorted(value(spark, text.char_ngrams(lit("aaab"), 3))) == ["aaa", "aab"]
    p = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<think>x</think> ok "
    assert value(spark, text.last_turn(lit(p), text.ASSISTANT)) == "<think>x</think> ok"
    assert value(spark, text.last_turn(lit("none"), text.USER)) == ""
    assert value(spark, text.strip_think(lit(" <think>a\nb</think>\n c "))) == "c"
    assert value(spark, text.tidy_lines(lit(" a  \r\nb\t\n"))) == "a\nb"
    assert value(spark, text.truncate(lit("abc def"), 4)) == "abc……"
    r, a = text.split_reasoning(lit("<think>one</think>x<think>two</think>"))
    assert (value(spark, r), value(spark, a)) == ("one\n\ntwo", "x")
    r, a = text.split_reasoning(lit("head<think>open"))
    assert (value(spark, r), value(spark, a)) == ("open", "head")
    block = '<|im_start|>assistant\n{"intent": "运动指导", "action": "tool_call"}<|im_end|>'
    assert value(spark, text.infer_action(lit(block))) == "tool_call"
    assert value(spark, text.infer_intent(lit(block), list(lookups.HEALTH.intents))) == "运动指导"
    assert value(spark, text.infer_intent(lit("意图：“其他”。"), list(lookups.HEALTH.intents))) == "其他"


def test_row_types(spark):
    kinds = {'{"trajectory": [], "prompt": 1}': "planner_trajectory", '{"prompt": null}': "final_prompt", '{"messages": [], "id": "a_executor"}': "executor_answer_sft", '{"messages": 1}': "message_sft", '{"user_query": ""}': "seed", "{}": "unknown", "oops": "unknown"}
    for raw, kind in kinds.items():
        assert value(spark, jsonx.row_type(lit(raw))) == kind


# Trajectories


def _steps(spark, items):
    return spark.createDataFrame([("t", "d", "q", json.dumps(items, ensure_ascii=False))], "id string, domain string, user_query string, raw string").withColumn("steps", nested.read_steps(F.col("raw")))


def test_legacy_shapes_and_forbidden_calls(spark):
    items = [
        {"step": 1, "planner_output": {"intent": "其他", "action": "tool_call", "tool_call": {"name": "search_web", "arguments": {"q": 1}}}, "observation": {"name": "search_web", "content": " hit "}},
        "bad",
        {"step": 2, "planner_output": {"action": "tool_call", "tool_calls": {"name": "write_file"}}, "observations": [{"name": "", "content": "x", "error": True}, 3]},
        {"step": 3, "planner_output": {"intent": "运动指导", "action": "planning_finish", "finish_reason": 'so "it"'}},
    ]
    rows = _steps(spark, items)
    got = rows.first().steps
    assert [len(s.planner_output.tool_calls) for s in got] == [1, 1, 0] and len(got[1].observations) == 1
    out = steps.explode_steps(rows, "sys", reasoning=False).collect()
    assert [r.id for r in out] == ["t_step_1"] and [m.role for m in out[0].messages] == ["system", "user", "assistant"]
    assert rows.select(nested.external_info(F.col("steps")).alias("v")).first().v == "【1. search_web】\nhit\n\n【2. tool_2（工具失败）】\nx"
    assert rows.select(nested.external_info(F.col("steps"), errors=False).alias("v")).first().v == "【1. search_web】\nhit"
    fixed = steps.repair_intents(rows, lookups.resolve(lookups.HEALTH)).first()
    assert fixed.changed_steps == 2 and [s.planner_output.intent for s in fixed.steps] == ["运动指导"] * 3
    assert steps.repair_intents(rows).first().changed_steps == 0
    assert json.loads(rows.select(nested.payload(F.element_at("steps", -1)["planner_output"]).alias("v")).first().v)["finish_reason"] == 'so "it"'


# Quotas


def test_quotas():
    assert numbers.mode_quotas(10, 0.3, 0.1) == {"no_tools": 3, "irrelevant_tools": 1, "normal": 6}
    assert sum(numbers.mode_quotas(7, 0.9, 0.9).values()) == 7
    assert numbers.quota(5, 0.5) == 3 and numbers.quota(0, 1) == 0
    assert numbers.removal_plan({"normal": 2, "no_tools": 9}, 8, 0.3, 0.1) == {"no_tools": 5, "irrelevant_tools": 0, "normal": 2}


def test_downsample_is_exact_and_repeatable(spark):
    rows = spark.createDataFrame([(i, "a" if i % 3 else "b", "normal") for i in range(60)], "id int, intent string, mode string")
    one, two = (sorted(r.id for r in sampling.downsample(rows.repartition(n), "id", "a", 12, no_tool_ratio=0, irrelevant_tool_ratio=0).where("removed").collect()) for n in (1, 7))
    assert one == two and len(one) == 12 and all(i % 3 for i in one)
    with pytest.raises(ValueError):
        sampling.downsample(rows, "id", "a", 40)


# Near-duplicates and components


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 501), (501, 500), (7, 7), (900, 900), (None, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 900: 900}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dedup_awkward_rows(spark):
    rows = [(0, "Hello, world! this is a text"), (1, "hello world THIS is a text."), (2, None), (3, ""), (4, "ab"), (5, "ab"), (6, "éé"), (7, "completely different words here"), (8, "hello world this is a text, ok")]
    df = spark.createDataFrame(rows, "idx long, t string")
    got = {r.idx: r.cluster for r in dedup.cluster(df, "idx", "t", threshold=0.7).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 0}
    assert {r.idx for r in dedup.deduplicate(df, "idx", "t", keep="last", threshold=0.7).collect()} == {2, 3, 4, 5, 6, 7, 8}
    log = dedup.duplicate_log(df, "idx", "t", keep="longest", threshold=0.7).collect()
    assert [(r.cluster_size, r.removed, r.kept.idx, [x.idx for x in r.removed_records]) for r in log] == [(3, 2, 8, [0, 1])]
    near = {r.idx: r.cluster for r in dedup.cluster(df, "idx", "t", threshold=0.7, method="minhash").collect()}
    assert near[0] == near[1] and near[7] == 7
    assert dedup.band_shape(0.9) == (5, 25) and dedup.band_shape(0.85) == (8, 16)


def test_minhash_tests_pairs_beyond_the_least(spark, monkeypatch):
    monkeypatch.setattr(dedup, "band_shape", lambda *_: (1, 1))
    rows = []
    for g in range(12):  # the least class is like neither of the others, which are alike
        k = 1000 * g
        common, both = list(range(k, k + 90)), list(range(k + 100, k + 120))
        rows += [(3 * g, common + list(range(k + 200, k + 220))), (3 * g + 1, [*common, *both, k + 300]), (3 * g + 2, [*common, *both, k + 400])]
    sets = spark.createDataFrame([(c, sorted(s), len(s)) for c, s in rows], "class long, grams array<bigint>, n int")
    met = {frozenset((3 * g + 1, 3 * g + 2)) for g in range(12)}
    least = {frozenset((r.left, r.right)) for r in dedup.minhash_pairs(sets, 0.9, verify=False).collect()}
    hidden = {p for p in met if frozenset((min(p) - 1, min(p))) in least and frozenset((min(p) - 1, max(p))) in least}
    found = {frozenset((r.left, r.right)) for r in dedup.minhash_pairs(sets, 0.9).collect()}
    assert len(hidden) > 3 and hidden <= found <= met


def _alike(grams):
    names = sorted(grams)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if len(grams[a] & grams[b]) >= 0.9 * len(grams[a] | grams[b])}


def _syllables(n=90):
    """Texts that share most of their trigrams, near copies of some, and copies."""
    draw = random.Random(4)
    parts = ["the", "on", "er", "in", "an", "re", "sh", "or", "ent", "ly"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.choice([12, 60, 60, 200, 900]))) for _ in range(n)]
    texts += [t[: len(t) // 2] + "xq" + t[len(t) // 2 :] for t in texts[::3]] + texts[::10]
    rows = list(enumerate(texts))
    least = {}
    for i, t in rows:
        least.setdefault(frozenset(t[k : k + 3] for k in range(len(t) - 2)), i)
    return rows, _alike({i: g for g, i in least.items()})


def test_exact_pairs_deal_no_row_for_each_gram(spark, monkeypatch):
    rows, want = _syllables()
    held = {}
    write = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label="table": (out := write(df, label), held.__setitem__(label, out.count()))[0])
    monkeypatch.setattr(dedup, "LEAST_IN_BLOCK", 8, raising=False)
    _, sets = dedup.classes(spark.createDataFrame(rows, "idx long, t string"), "idx", "t")
    got = dedup.similar_sets(sets).collect()
    assert len(got) == len(want) > 20 and {(r.left, r.right) for r in got} == want
    assert max(n for label, n in held.items() if label != "candidates") <= len(rows)


def test_minhash_writes_no_table_of_sets(spark, monkeypatch):
    rows, want = _syllables()
    rows += [(k, "same id, first " * 9 + rows[k][1][::-1]) for k in range(0, 90, 9)]  # ids repeat with other texts
    df, held = spark.createDataFrame(rows, "idx long, t string"), []
    links = dedup.minhash_pairs(dedup.classes(df, "idx", "t")[1], 0.9)
    root = {i: i for i, _ in rows}
    for _ in range(len(root)):
        for r in (pairs := links.collect()) if not _ else pairs:
            root[r.left] = root[r.right] = min(root[r.left], root[r.right])
    write = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label="table": (held.extend(t for _, t in df.dtypes), write(df, label))[1])
    for most in (dedup.BROADCAST, 0) if hasattr(dedup, "BROADCAST") else (0,):
        monkeypatch.setattr(dedup, "BROADCAST", most, raising=False)
        got = dedup.cluster(df, "idx", "t", method="minhash").collect()
        assert len(got) == len(rows) and all(r.cluster == root[r["class"]] for r in got)
    assert len({root[i] for i in root}) < len(root) - 10 and "binary" not in held


def test_clusters_verify_pairs_once_and_keep_a_forest(spark, monkeypatch):
    rows, want = _syllables()
    held = {}
    write = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label="table": (out := write(df, label), held.__setitem__(label, out.count()))[0])
    monkeypatch.setattr(dedup, "LEAST_IN_BLOCK", 8, raising=False)
    got = {r.idx: r for r in dedup.cluster(spark.createDataFrame(rows, "idx long, t string"), "idx", "t").collect()}
    root = {r["class"]: r["class"] for r in got.values()}
    for _ in root:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    assert all(r.cluster == root[r["class"]] for r in got.values())
    assert held["links"] < len(want)


# Merges


def test_merge_by_signature(spark):
    first = [(0, '{"id": "1", "messages": [1]}'), (1, '{"id": "1", "messages": [2]}'), (2, "oops"), (3, "[1]")]
    second = [(0, '{"messages": [1], "id": "9"}'), (1, '{"id": "5"}'), (2, '{"text": "", "query": "q"}'), (3, '{"query": "q"}')]
    frames = [spark.createDataFrame(x, "row_idx int, raw string") for x in (first, second)]
    kept = lambda **o: sorted((r.src, r.row_idx) for r in merge.merge_tasks(frames, **o).where("written").collect())
    assert kept() == [(0, 0), (0, 1), (0, 3), (1, 1), (1, 2)]
    assert kept(dedup_by="id") == [(0, 0), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]
    assert len(kept(dedup_by="none")) == 7 and kept(max_rows=1) == [(0, 0), (1, 1)]
    held = spark.createDataFrame([('{"messages": [2]}',), ("no",), ("[1]",)], "raw string")
    assert kept(existing=held) == [(0, 0), (1, 1), (1, 2)] and len(kept(existing=held, dedup_by="none")) == 7
    report = {r.src: (r.read, r.written, r.duplicated, r.invalid) for r in merge.merge_report(merge.merge_tasks(frames)).collect()}
    assert report == {0: (4, 3, 0, 1), 1: (4, 2, 2, 0)}


def test_merge_compares_whole_texts(spark):
    """A text that starts with a number, or a line with more behind its first value: Spark's parser stops there."""
    texts = ["4389058605216978 one", "4389058605216978 two", "4389058605216978", "0", "0", "false"]
    lines = [json.dumps({"id": i, "text": t}) for i, t in enumerate(texts)] + ['{"text": "z"} and more', '1] junk, "s"]', '{"text": 0}']
    rows = spark.createDataFrame(list(enumerate(lines)), "row_idx int, raw string")
    merged = merge.merge_tasks([rows]).collect()
    assert sorted(r.row_idx for r in merged if r.written) == [0, 1, 2, 3, 5, 8] and sorted(r.row_idx for r in merged if not r.valid) == [6, 7]
    report = merge.merge_report(merge.merge_tasks([rows])).first()
    assert (report.read, report.written, report.duplicated, report.invalid) == (9, 6, 1, 2)
    assert [r.status for r in jsonl.classify(rows).orderBy("row_idx").collect()][5:] == ["object", "invalid", "invalid", "object"]


def test_executor_requests_read_a_line_few_times(spark):
    """A plan that repeats what several branches use grew to 162 reads of the line's JSON; steps don't go to a teacher."""
    raw = '{"id": 1, "user_query": "q", "trajectory": [], "history": {"user": " a ", "answer": "b"}, "tool_names": "t"}'
    asked = roles.executor_requests(spark.createDataFrame([(0, raw)], "line_no long, raw string"), lookups.HEALTH, "s")
    assert "steps" not in asked.columns and asked._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") < 60
    got = asked.first()
    assert (got.recent_history_text, got.fixed_tool_names, got.intent) == ("用户：a\n助手：b", ["t"], "其他")


def test_fixed_metadata(spark):
    raw = lit('{"step": "3", "include_reasoning": "false", "tool_names": ["a", "b"], "planner_overridden": 0, "intent": null, "source": {"a": 1}}')
    got = value(spark, merge.fixed_metadata(raw, "executor_answer"))
    assert (got.merge_source, got.step, got.include_reasoning, got.tool_names, got.planner_overridden, got.intent, got.source) == ("executor_answer", 3, True, "a,b", False, "", '{"a":1}')
    assert list(got.asDict()) == list(merge.METADATA)


# Sessions


def test_compression_points(spark):
    turns = F.transform(F.sequence(lit(1), lit(9)), lambda i: F.struct(i.cast("string").alias("user"), lit("a").alias("assistant")))
    points = lambda recent, every: value(spark, sessions.compression_points(turns, recent, every))
    assert points(3, 2) == [4, 6, 8] and points(3, 5) == [5] and points(9, 1) == []
    older, recent = sessions.split_history(turns, 3)
    assert len(value(spark, older)) == 6 and [t.user for t in value(spark, recent)] == ["7", "8", "9"]
    older, recent = sessions.split_history(turns, 0)
    assert value(spark, older) == [] and len(value(spark, recent)) == 9


# Sources, sinks, increments


def test_jsonl_accounting(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('\noops\n[1,2]\n"s"\n{"id":1}\n{"id":"é"}', encoding="utf-8")
    url = f"file://{path}"
    assert jsonl.accounting(jsonl.classify(jsonl.lines(spark, url))).first().asDict() == {"total_lines": 6, "blank_lines": 1, "invalid_lines": 3, "json_rows": 2}
    assert [r.id for r in jsonl.read_lenient(spark, url, "id string").collect()] == ["1", "é"]
    assert jsonl.count_lines(spark, url) == 5 and {r.id for r in jsonl.processed_ids(spark, url).collect()} == {"1", "é"}
    assert [r.line_no for r in jsonl.page(spark, url, 2, 2).collect()] == [2, 3]
    assert jsonl.read_strict(spark, f"file://{tmp_path}/none", "id string").count() == 0
    out = f"file://{tmp_path}/out"
    sinks.write(jsonl.read_lenient(spark, url, "id string").select("id"), out)
    sinks.append(spark.createDataFrame([("z",)], "id string"), out)
    sinks.replace(jsonl.read_lenient(spark, out, "id string").select("id"), out)
    assert sorted(r.id for r in jsonl.read_lenient(spark, out, "id string").collect()) == ["1", "z", "é"]


def test_incremental_run_is_idempotent(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"id":"1"}\n{"id":"1"}\n{"id":"2"}\n')
    args = (spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    for k in ("c1", "c1", "c2"):
        incremental.run_available(*args, f"file://{tmp_path}/{k}", lambda rows: rows.select("id"))
    assert sorted(r.id for r in jsonl.read_lenient(spark, args[2], "id string").collect()) == ["1", "2"]


# Every query against its SQL


def _comparable(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    show = lambda x: f"{x:.9g}" if isinstance(x, float) else repr([show(y) for y in x]) if isinstance(x, (list, tuple)) else repr(x)
    return sorted(tuple(show(r[i]) for i in at) for r in rows)


def test_every_query_matches_its_sql(spark):
    import duckdb

    import __spark_entry__ as entry
    from siltmill.plans import catalog

    base = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{base}/{t}.parquet'")
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert entry.entry(spark).count() > 0
    for name, sql in catalog.oracle_sql().items():
        df = catalog.queries()[name](spark, base)
        found = con.execute(sql)
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(df.columns), name
        assert _comparable([tuple(r) for r in df.collect()], df.columns) == _comparable(found.fetchall(), columns), name
