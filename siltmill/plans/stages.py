"""The stages, from JSON-lines paths to JSON-lines paths.

Each takes the parameters of its stage under their usual names and returns its counts. Those that ask a
model take it as a callable; the command line has the others.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions import extract, jsonx, nested, text, validation
from siltmill.functions.lookups import HEALTH, Domain, resolve
from siltmill.operators import ablation, dedup, merge, planner, reports, review, roles, sampling, steps, teacher
from siltmill.scratch import materialize
from siltmill.sources import jsonl, sinks


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, raw, status)`` of all lines, in order."""
    return jsonl.classify(jsonl.numbered(jsonl.lines(spark, path))).select("line_no", "raw", "status")


def _strict(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, raw)`` of all rows; a line that is no object fails the stage."""
    rows = _rows(spark, path).where("status <> 'blank'")
    bad = rows.where("status <> 'object'").count()
    if bad:
        raise ValueError(f"{path}: {bad} lines are no JSON objects")
    return rows.select("line_no", "raw")


def _write_raw(rows: DataFrame, path: str, order: str = "line_no", mode: str = "overwrite") -> None:
    rows.orderBy(order).select("raw").write.mode(mode).text(path)


def _replace_raw(rows: DataFrame, path: str, backup: bool) -> None:
    sinks.replace(rows.orderBy("line_no").select("raw"), path, backup, raw=True)


def _done(spark: SparkSession, output: str, force_rebuild: bool) -> DataFrame | None:
    return None if force_rebuild else jsonl.processed_ids(spark, output)


def _write_rows(rows: DataFrame, output: str, force_rebuild: bool, order: str = "line_no") -> None:
    sinks.write(rows.orderBy(order).drop(order), output, "overwrite" if force_rebuild else "append")


def dedup_final_prompt(
    spark: SparkSession, input: str, output: str, duplicates: str | None = None, text_field: str | None = None, dedup_key: str = "auto", threshold: float = 0.9,
    ngram: int = 3, method: str = "auto", num_perm: int = 128, min_chars: int = 3, keep: str = "longest", dry_run: bool = False, max_rows: int | None = None,
    in_place: bool = False, no_backup: bool = False,
) -> dict:
    """``in_place`` replaces the input, which is backed up first unless ``no_backup``."""
    rows = _rows(spark, input)
    good = rows.where("status = 'object'")
    good = good.orderBy("line_no").limit(max_rows) if max_rows is not None else good
    good = materialize(good.withColumn("text", extract.dedup_text(F.col("raw"), text_field, dedup_key)), "texts")
    marked = materialize(dedup.representatives(dedup.cluster(good, "line_no", "text", threshold, ngram, method, num_perm, min_chars)), "clusters")
    stats = dedup.dedup_stats(marked).first().asDict()
    stats["invalid_rows"] = rows.where("status in ('invalid', 'other')").count()
    if not dry_run:
        kept = good.join(marked.where(f"keep_{keep}").select(F.col("idx").alias("line_no")), "line_no", "left_semi")
        if in_place:
            _replace_raw(kept, input, not no_backup)
        else:
            _write_raw(kept, output)
        if duplicates:
            log = dedup.duplicate_log(good, "line_no", "text", keep, data="raw", marked=marked)
            sinks.write(log.withColumns({"threshold": F.lit(threshold), "ngram": F.lit(ngram), "method": F.lit(method), "dedup_key": F.lit(dedup_key)}), duplicates)
    return stats


def reviewed_final_prompt(spark: SparkSession, merged_input: str, reviews_input: str, output: str, rejected_output: str) -> dict:
    """Approved rows as they were; rejected ones as ``{sample, review}``."""
    reviews = _rows(spark, reviews_input).where("status = 'object'").select(
        F.col("line_no").alias("row_idx"), "raw", *(F.get_json_object("raw", f"$.{k}").alias(k) for k in ("source_sample_id", "source_id", "decision"))
    )
    merged = _rows(spark, merged_input).where("status = 'object'").select("line_no", "raw", F.get_json_object("raw", "$.id").alias("id"), F.get_json_object("raw", "$.metadata.merge_source").alias("merge_source"))
    if merged.where("id is null").limit(1).count():
        raise ValueError("a merged row has no id")
    out = materialize(review.split(merged, reviews), "reviewed")
    _write_raw(out.where("outcome = 'approved'"), output)
    last = review.latest_reviews(reviews, "row_idx", ("raw",)).select("key", F.col("raw").alias("review"))
    bad = out.where("outcome = 'rejected'").join(last, F.col("id") == F.col("key"))
    pair = F.concat(F.lit('{"sample": '), F.col("raw"), F.lit(', "review": '), F.col("review"), F.lit("}"))
    _write_raw(bad.select("line_no", pair.alias("raw")), rejected_output)
    return review.split_stats(out, reviews).first().asDict()


def merge_tasks(spark: SparkSession, input: list[str], output: str, dedup_by: str = "auto", max_rows: int | None = None, report: str | None = None, force_rebuild: bool = False) -> dict:
    """Adds to ``output`` what it doesn't hold yet; inputs that don't exist are reported as missing."""
    there = [jsonl.exists(spark, p) for p in input]
    empty = spark.createDataFrame([], "row_idx long, raw string")
    numbered = lambda p: jsonl.numbered(jsonl.classify(jsonl.lines(spark, p)).where("status <> 'blank'")).select(F.col("line_no").cast("long").alias("row_idx"), "raw")
    sources = [numbered(p) if t else empty for p, t in zip(input, there, strict=True)]
    held = None
    if not force_rebuild and jsonl.exists(spark, output):
        held = jsonl.lines(spark, output).select("raw").where(F.length(F.trim("raw")) > 0)
    before = held.count() if held is not None else 0
    merged = materialize(merge.merge_tasks(sources, dedup_by=dedup_by, max_rows=max_rows, existing=held), "merged")
    merged.where("written").orderBy("src", "row_idx").select("raw").write.mode("append" if held is not None else "overwrite").text(output)
    counts = {r["src"]: r.asDict() for r in merge.merge_report(merged).collect()}  # one row an input
    none = dict.fromkeys(("read", "written", "duplicated", "invalid"), 0)
    parts = [{"path": p, **none, **{k: v for k, v in counts.get(i, {}).items() if k != "src"}, "missing": not t} for i, (p, t) in enumerate(zip(input, there, strict=True))]
    found = {"inputs": input, "output": output, "dedupBy": dedup_by, "forceRebuild": force_rebuild, "sources": parts}
    found |= {k: sum(s[k] for s in parts) for k in none}
    found |= {"before": before, "after": before + found["written"]}
    if report:
        spark.createDataFrame([(json.dumps(found, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(report)
    return found


def data_stats(spark: SparkSession, paths: list[str], format: str = "markdown", output: str | None = None, max_rows: int | None = None, domain: Domain = HEALTH, detail: bool = True, counters_output: str | None = None) -> str:
    """A report of each file, as markdown (highlights and distributions, and with ``detail`` all figures) or JSON. ``counters_output``
    gets every value of every counter, which a report has up to a thousand of."""
    parts = []
    for path in paths:
        rows = materialize(_rows(spark, path), "stats")
        lines = jsonl.accounting(rows).first().asDict()
        good = rows.where("status = 'object'").withColumnRenamed("line_no", "row_idx")
        good = good.orderBy("row_idx").limit(max_rows) if max_rows is not None else good
        first = good.orderBy("row_idx").select(jsonx.row_type(F.col("raw")).alias("t"), jsonx.has_key(F.get_json_object("raw", "$.metadata"), "step").alias("stepwise")).first()
        kind = "empty_or_unknown" if first is None else first["t"]
        if kind == "message_sft" and first["stepwise"]:
            kind = "planner_step_sft"
        if kind == "final_prompt":
            source = F.get_json_object("raw", "$.metadata.merge_source")
            if "merged" in path.rsplit("/", 1)[-1] or good.where(source.isin("planner_final", "executor_answer")).limit(1).count():
                kind = "merged_final_prompt"
        parts.append((path, kind, lines, reports.report(good, kind, domain.intents)))
        if counters_output:
            full = reports.counters(good, reports.spec_of(kind, list(domain.intents)), "row_idx").select(F.lit(path).alias("path"), "counter", "value", "n")
            sinks.write(full, counters_output, "overwrite" if path == paths[0] else "append")
    if format == "json":
        made = json.dumps([{"path": p, "file_type": k, **line, "highlights": reports.highlights(k, s, line["invalid_lines"]), "stats": s} for p, k, line, s in parts], ensure_ascii=False, indent=2)
    else:
        made = "\n".join(reports.markdown(p.rsplit("/", 1)[-1], k, s, line["invalid_lines"], detail=detail) for p, k, line, s in parts)
    if output:
        spark.createDataFrame([(made,)], "value string").coalesce(1).write.mode("overwrite").text(output)
    return made


def planner_step_sft(spark: SparkSession, input: str, output: str, system: str, no_reasoning: bool = False, force_rebuild: bool = False, catalog: str = "[]") -> int:
    """``catalog`` is the JSON list of a domain's tools, which rows without a field ``tools`` expose."""
    rows = _rows(spark, input).where("status = 'object'")
    raw = F.col("raw")
    read = rows.select(
        "line_no", F.get_json_object(raw, "$.id").alias("id"), F.coalesce(F.get_json_object(raw, "$.domain"), F.lit("health")).alias("domain"), F.coalesce(F.get_json_object(raw, "$.user_query"), F.lit("")).alias("user_query"),
        nested.read_steps(F.coalesce(F.get_json_object(raw, "$.trajectory"), F.lit("[]"))).alias("steps"), nested.exposed_tools(raw, catalog).alias("tools"),
    )
    out = steps.explode_steps(read, system, reasoning=not no_reasoning, tools="tools")
    fresh = out if force_rebuild else merge.resume(out, jsonl.processed_ids(spark, output))
    sinks.write(fresh, output, "overwrite" if force_rebuild else "append")
    return jsonl.count_lines(spark, output)


def fix_intents(spark: SparkSession, input: str, output: str | None = None, domain: Domain | None = HEALTH, dry_run: bool = False, in_place: bool = False, no_backup: bool = False) -> dict:
    """Rows with back-filled intents in the steps of their trajectories, and all that follows from them; blank and
    invalid lines and unchanged rows pass through as they are. ``in_place`` replaces the input."""
    rows = _rows(spark, input)
    parsed = rows.withColumn("steps", nested.read_steps(F.coalesce(F.get_json_object(F.when(F.col("status") == "object", F.col("raw")), "$.trajectory"), F.lit("[]"))))
    found = parsed.withColumns({"changed": F.array().cast("array<int>"), "intent": F.lit(None).cast("string")})
    if domain:
        known = resolve(domain)
        differs = nested.backfilled(F.col("steps"), nested.backfill(F.col("steps"), known))
        found = parsed.withColumns({"changed": differs, "intent": known(F.try_element_at("steps", F.lit(-1))["planner_output"]["intent"])})
    found = materialize(found.drop("steps"), "fixed")
    count = found.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "object").alias("json_rows"), F.count_if(F.col("status").isin("invalid", "other")).alias("invalid"), F.count_if(F.size("changed") > 0).alias("changed_rows"), F.sum(F.size("changed")).alias("changed_steps"))
    if not dry_run:
        fixed = found.withColumn("raw", roles.repaired(F.col("raw"), F.col("changed"), F.col("intent"), domain)) if domain else found
        if in_place:
            _replace_raw(fixed, input, not no_backup)
        else:
            _write_raw(fixed, output or f"{input}.intent_fixed")
    return count.first().asDict()


def planner_final_prompt(spark: SparkSession, input: str, output: str, force_rebuild: bool = False, model_template: Callable[[list, list], str] | None = None) -> dict:
    """Chat samples as prompts, with their metadata as it is. ``model_template`` takes messages and tools."""
    raw = F.col("raw")
    rows = _strict(spark, input).select("line_no", "raw", roles.row_id(raw, F.col("line_no"), "line").alias("id"))
    fresh, counts = merge.add_new(rows, _done(spark, output, force_rebuild), "line_no")
    metadata = F.try_parse_json(F.coalesce(F.get_json_object("raw", "$.metadata"), F.when(jsonx.has_key(raw, "metadata"), "null").otherwise("{}")))
    _write_rows(fresh.select("line_no", "id", roles.rendered(raw, None, model_template).alias("prompt"), metadata.alias("metadata")), output, force_rebuild)
    return counts


def merged_final_prompt(
    spark: SparkSession, planner_final: str, executor_input: str, output: str, assembly: dict | None = None, force_rebuild: bool = False, max_planner_samples: int | None = None,
    max_executor_samples: int | None = None, model_template: Callable[[list, list], str] | None = None,
) -> dict:
    """Planner prompts, then executor answers as prompts, under one metadata schema, by first id.

    ``assembly`` maps the known domains to the system prompt that replaces a sample's own, or None; rows of
    unknown domains are ``health``. A missing input is skipped.
    """
    assembly = {"health": None} | (assembly or {})
    done, raw, counts, made = _done(spark, output, force_rebuild), F.col("raw"), {}, []
    none = spark.createDataFrame([], "line_no long, raw string")
    read = lambda p: _strict(spark, p) if jsonl.exists(spark, p) else none
    rows = read(planner_final).select("line_no", "raw", roles.row_id(raw, F.col("line_no"), "planner_final_line").alias("id"))
    fresh, found = merge.add_new(rows, done, "line_no", max_planner_samples, roles.truthy(raw, "prompt").isNotNull())
    counts |= {f"planner_{k}": v for k, v in found.items()}
    open_ = F.get_json_object("raw", "$.metadata")
    made.append(fresh.select(F.struct(F.lit(0).alias("src"), "line_no").alias("at"), "id", F.get_json_object("raw", "$.prompt").alias("prompt"), merge.fixed_metadata(open_, "planner_final").alias("metadata")))
    ids = fresh.select("id")
    rows = read(executor_input).select("line_no", "raw", roles.row_id(raw, F.col("line_no"), "executor_line").alias("id"))
    fresh, found = merge.add_new(rows, ids if done is None else done.unionByName(ids), "line_no", max_executor_samples, roles.truthy(raw, "messages").isNotNull())
    counts |= {f"executor_{k}": v for k, v in found.items()}
    named = F.coalesce(roles.truthy(raw, "domain"), roles.truthy(raw, "metadata.domain"), F.lit("health"))
    name = F.when(named.isin(*assembly), named).otherwise("health")
    system = F.coalesce(*(F.when(name == k, F.lit(v.strip())) for k, v in assembly.items() if v is not None), F.lit(None).cast("string"))
    extra = {
        "domain": name, "source_id": F.get_json_object(raw, "$.source_id"), "intent": F.get_json_object(raw, "$.intent"), "has_clarification_ask": F.get_json_object(raw, "$.clarification_ask").isNotNull(),
        "executor_assembly_system_prompt_source": F.when(system.isNotNull(), "domain").otherwise("executor_messages"),
    }
    made.append(fresh.select(F.struct(F.lit(1).alias("src"), "line_no").alias("at"), "id", roles.rendered(raw, system, model_template).alias("prompt"), merge.fixed_metadata(open_, "executor_answer", extra=extra).alias("metadata")))
    _write_rows(made[0].unionByName(made[1]), output, force_rebuild, "at")
    return counts | {"total_added": counts["planner_added"] + counts["executor_added"], "total_skipped": counts["planner_skipped"] + counts["executor_skipped"]}


def executor_answer(
    spark: SparkSession, input: str, output: str, ask: Callable[[dict], dict], system: str, domain: Domain = HEALTH, max_samples: int = 10000, max_retries: int = 5, max_external_chars: int = 6000,
    no_reasoning: bool = False, no_tool_errors: bool = False, plan_tools: tuple[str, ...] = (), expected_intents: tuple[str, ...] = (), force_rebuild: bool = False,
) -> int:
    """Answers to the questions of trajectories. ``ask`` takes ``{"messages": ...}`` and gives ``{"reasoning_content", "content"}``;
    rows it fails on are left for the next run. Returns the rows added."""
    made = roles.executor_requests(_strict(spark, input), domain, system, max_external_chars, not no_tool_errors, plan_tools, expected_intents)
    done = _done(spark, output, force_rebuild)
    pending = merge.resume(made, done, limit=max_samples, order="line_no") if done is not None else made.orderBy("line_no").limit(max_samples)
    rows = roles.executor_rows(teacher.ask(pending, "request", ask, max_retries), domain, not no_reasoning, max_external_chars, not no_tool_errors)
    rows = materialize(rows, "answers")  # a teacher is asked once
    _write_rows(rows, output, force_rebuild)
    return rows.count()


def review_results(
    spark: SparkSession, input: str, output: str, ask: Callable[[dict], dict], system: str, domain: Domain = HEALTH, max_samples: int = 10000, max_retries: int = 5, max_answer_chars: int = 12000,
    min_pass_score: int = 3, force_rebuild: bool = False,
) -> int:
    """Reviews of executor samples; ``ask`` gives ``{"content": ...}`` with the review as JSON text. Returns the rows added."""
    made = materialize(roles.review_requests(_strict(spark, input), domain, system, max_answer_chars), "requests")
    if made.where("id is null").limit(1).count():
        raise ValueError("an executor sample has no id or source_id")
    done = _done(spark, output, force_rebuild)
    pending = merge.resume(made, done, limit=max_samples, order="line_no") if done is not None else made.orderBy("line_no").limit(max_samples)
    if pending.where("answer_text = ''").limit(1).count():
        raise ValueError("an executor sample has no answer")
    if pending.isEmpty():
        return 0
    rows = materialize(roles.review_rows(roles.reviewed(pending, ask, max_retries), min_pass_score), "reviewed")
    _write_rows(rows, output, force_rebuild)
    return rows.count()


def planner_trajectories(
    spark: SparkSession, input: str, output: str, ask: Callable[[dict], dict], run: Callable[[str, dict, dict], str], system: str, catalog: list[dict], domain: Domain = HEALTH, loop: planner.Loop = planner.Loop(),
    max_samples: int = 15000, expected_intents: tuple[str, ...] = (), no_tool_ratio: float = 0.3, irrelevant_tool_ratio: float = 0.1, tool_failure_ratio: float = 0.1, max_tool_count: int | None = 4, force_rebuild: bool = False,
) -> int:
    """Trajectories of seeds that have none yet; seeds whose planner fails are left for the next run. Returns the rows added."""
    rows = _strict(spark, input).withColumn("id", F.get_json_object("raw", "$.id"))
    wanted = planner.requested_intents(expected_intents, domain)
    if wanted:
        rows = rows.where(resolve(domain)(F.get_json_object("raw", "$.expected_intent")).isin(*wanted))
    done = _done(spark, output, force_rebuild)
    pending = merge.resume(rows, done, limit=max_samples, order="line_no") if done is not None else rows.orderBy("line_no").limit(max_samples)
    drawn = planner.seeds(pending.drop("id"), domain, no_tool_ratio, irrelevant_tool_ratio, tool_failure_ratio, max_tool_count, loop.seed)

    def work(seed: dict) -> list[tuple[str, dict]]:
        row = planner.referenced(seed, ask, run, catalog, domain, system, loop)
        return [("planner", row)] if row else []

    made = materialize(planner.run_rows(drawn, work), "trajectories")
    _write_raw(made, output, mode="overwrite" if force_rebuild else "append")
    return made.count()


def multiturn(
    spark: SparkSession, input: str, output_session: str, output_planner: str, output_executor: str, ask: Callable[[dict], dict], run: Callable[[str, dict, dict], str], answer: Callable[[dict], str | None],
    simulate: Callable[[dict], dict], compress: Callable[[str, str], str], system: str, catalog: list[dict], domain: Domain = HEALTH, loop: planner.Loop = planner.Loop(), max_samples: int = 100, max_turns: int = 3,
    min_turns: int = 2, compress_every_turns: int = 2, force_rebuild: bool = False,
) -> dict:
    """Sessions of the first seeds, and the planner and executor rows of their turns. Returns the rows of each kind."""
    drawn = planner.seeds(_strict(spark, input).orderBy("line_no").limit(max_samples), domain, seed=loop.seed)
    made = planner.sessions(drawn, ask, run, answer, simulate, compress, catalog, domain, system, loop, max_turns, min_turns, compress_every_turns)
    made = materialize(made, "sessions")
    counts = {}
    for kind, path in (("session", output_session), ("planner", output_planner), ("executor", output_executor)):
        part = made.where(F.col("kind") == kind)
        part.orderBy("line_no", "n").select("raw").write.mode("overwrite" if force_rebuild else "append").text(path)
        counts[kind] = part.count()
    return counts


def rag_summary(spark: SparkSession, input: str, output: str, ask: Callable[[dict], dict], max_chars: int = 3000, max_retries: int = 3) -> dict:
    """Reference knowledge from answered questions. ``ask`` takes the question and reply, cut at ``max_chars``, and gives
    ``{"content"}``; a row it fails on is written with an empty summary. Ids written before are skipped."""
    get = lambda k: F.coalesce(F.get_json_object("raw", f"$.{k}"), F.lit(""))
    rows = _strict(spark, input).select("line_no", *(get(k).alias(k) for k in ("id", "user_query", "assistant_reply", "expected_intent")))
    pending = merge.resume(rows, jsonl.processed_ids(spark, output))
    request = F.to_json(F.struct(F.left("user_query", F.lit(max_chars)).alias("query"), F.left("assistant_reply", F.lit(max_chars)).alias("reply")))
    said = teacher.ask(pending.withColumn("request", request), "request", ask, max_retries)
    summary = F.coalesce(text.strip(F.get_json_object("answer", "$.content")), F.lit(""))
    made = materialize(said.select("line_no", "id", "user_query", "assistant_reply", summary.alias("rag_summary"), "expected_intent", F.col("error").isNotNull().alias("failed")), "summaries")
    _write_rows(made.drop("failed"), output, False)
    return made.agg(F.count("*").alias("written"), F.count_if("failed").alias("failed")).first().asDict()


def no_intent_executor(
    spark: SparkSession, input: str, output: str, system: str, no_reasoning: bool = True, require_external_info: bool = False, max_samples: int | None = None, shuffle: bool = False, seed: int = 42,
    ask: Callable[[dict], dict] | None = None, max_attempts: int = 3, force_rebuild: bool = True,
) -> int:
    """Answers without their intent: copied, or, with ``ask``, written anew from question and external information until
    one passes the checks. ``ask`` gives ``{"answer", "reasoning"}``. ``shuffle`` takes the rows in a seeded order."""
    rows = _rows(spark, input).where("status = 'object'")
    get = lambda p, n: F.get_json_object("raw", p).alias(n)
    read = rows.select("line_no", get("$.id", "id"), get("$.source_id", "source_id"), get("$.user_query", "user_query"), get("$.intent", "intent"), get("$.external_info", "external_info"), get("$.executor_raw_output.reasoning_content", "reasoning_content"), get("$.executor_raw_output.content", "content"))
    if require_external_info:
        read = read.where(text.strip(F.coalesce("external_info", F.lit(""))) != "")
    if max_samples is not None:
        read = read.orderBy(*([F.xxhash64(F.lit(seed), "line_no")] if shuffle else []), "line_no").limit(max_samples)
    source = "executor_no_intent_copy"
    if ask is not None:
        source = "executor_no_intent_api"
        done = _done(spark, output, force_rebuild)
        if done is not None:
            named = done.select(F.regexp_replace("id", "_no_intent$", "").alias("id"))
            read = merge.resume(read, named)
        read = read.where(text.strip(F.coalesce("user_query", F.lit(""))) != "").drop("content", "reasoning_content")
        told = lambda k: F.get_json_object("answer", f"$.{k}")
        request = F.to_json(F.struct(ablation.user_prompt(F.col("user_query"), F.col("external_info")).alias("prompt")))
        good, _ = teacher.ask_until(read, lambda k: request, ask, validation.no_intent_answer(told("answer"), told("reasoning")), max_attempts)
        read = good.withColumns({"content": told("answer"), "reasoning_content": told("reasoning")}).drop("answer")
    made = ablation.copy_rows(read, system, not no_reasoning, require_external_info, source)
    sinks.write(made, output, "overwrite" if force_rebuild else "append")
    return jsonl.count_lines(spark, output)


def identity_sft(
    spark: SparkSession, output: str, ask: Callable[[dict], dict], name: str, team: str, planner_system: str, executor_system: str, topics: tuple[str, ...], other_topics: tuple[str, ...] = (), catalog: tuple[str, ...] = (),
    planner_total: int = 240, executor_total: int = 240, max_attempts: int = 3, seed: int = 42, kinds: tuple[str, ...] = ("planner", "executor"),
) -> dict:
    """Samples in which the model says who it is. ``ask`` takes a kind, a topic and the tools shown, and gives ``{"content"}``
    with user_query, reasoning and, for the executor, answer as JSON; what breaks the rules is asked again with another
    topic. A fifth of the topics are ``other_topics``, a quarter of the plans show no tools, the others two to six."""
    counts, parts = {}, []
    for kind, total in (("planner", planner_total), ("executor", executor_total)):
        if kind not in kinds:
            continue
        rows = spark.range(total).select(F.format_string(f"identity_{kind}_llm_%05d", "id").alias("id"))
        rows = merge.resume(rows, jsonl.processed_ids(spark, output))
        draw = lambda n, what, k, kind=kind: F.pmod(F.xxhash64(F.lit(seed), F.lit(kind), F.lit(what), F.lit(k), "id"), F.lit(n))
        names = F.array(*(F.lit(c) for c in catalog)).cast("array<string>")
        most, few = min(6, len(catalog)), min(2, len(catalog))
        mixed = F.transform(F.array_sort(F.transform(names, lambda t: F.struct(F.xxhash64(F.lit(seed), "id", t).alias("h"), t.alias("t")))), lambda s: s["t"])
        shown = F.when(draw(4, "mode", 0) == 0, F.array().cast("array<string>")).otherwise(F.slice(mixed, F.lit(1), (few + draw(most - few + 1, "count", 0)).cast("int")))
        rows = rows.withColumn("tools", shown if kind == "planner" and catalog else F.array().cast("array<string>"))

        def request(k: int, kind=kind, draw=draw) -> Column:
            pick = lambda of: F.element_at(F.array(*(F.lit(t) for t in of)), (draw(len(of), "topic", k) + 1).cast("int"))
            topic = F.when(draw(5, "language", k) == 0, pick(other_topics)).otherwise(pick(topics)) if other_topics else pick(topics)
            return F.to_json(F.struct(F.lit(kind).alias("kind"), topic.alias("topic"), F.col("tools")))

        said = jsonx.lenient_object(F.get_json_object("answer", "$.content"))
        field = lambda k, said=said: text.strip(F.coalesce(jsonx.field(said, f"$.{k}"), F.lit("")))
        reason = validation.identity_answer(field("user_query"), field("answer"), field("reasoning"), name, team) if kind == "executor" else validation.identity_plan(field("user_query"), field("reasoning"))
        good, bad = teacher.ask_until(rows, request, ask, F.when(~jsonx.is_object(said), "not_dict").otherwise(reason), max_attempts)
        plan = F.concat(F.lit('{"intent": "其他", "action": "planning_finish", "finish_reason": "'), F.when(F.size("tools") > 0, IDENTITY_WITH_TOOLS).otherwise(IDENTITY_NO_TOOLS), F.lit('"}'))
        body = text.compose_reasoning(field("reasoning"), field("answer") if kind == "executor" else plan)
        message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
        chat = F.array(message("system", F.lit(executor_system if kind == "executor" else planner_system)), message("user", field("user_query")), message("assistant", body))
        mode = F.when(F.size("tools") > 0, "random_subset").otherwise("no_tools") if kind == "planner" else F.lit("")
        extra = {
            "source": F.lit(f"identity_{kind}_llm"), "action": F.lit("planning_finish"), "include_reasoning": F.lit(True), "tool_names": F.array_join("tools", ","), "answer_template_intent": F.lit("其他"),
            "planner_tool_sampling_mode": mode, "intent": F.lit("其他"),
        }
        fields = {k: v for k, v in merge.METADATA.items() if k not in ("domain", "executor_assembly_system_prompt_source")}
        parts.append(good.select("id", text.chatml(chat).alias("prompt"), merge.fixed_metadata(F.lit("{}"), "identity", fields, extra).alias("metadata")))
        counts[f"{kind}_failed"] = sum(bad.values())
    made = materialize(reduce(DataFrame.unionByName, parts), "identity")
    _write_rows(made.withColumn("line_no", F.col("id")), output, False)
    return counts | {"written": made.count()}


# Why a planner ends at once when it is asked who it is.
IDENTITY_NO_TOOLS = "用户问题为自我介绍/身份澄清/能力咨询类，不属于健康管理意图，当前也未提供工具，直接结束规划由下游回答。"
IDENTITY_WITH_TOOLS = "用户问题为自我介绍/身份澄清/能力咨询类，不属于健康管理意图，所列工具与该问题无关，无需调用，直接结束规划由下游回答。"


def downsample(spark: SparkSession, input: str, output: str, target_intent: str, remove_count: int, removed_output: str | None = None, seed: int = 42, domain: Domain = HEALTH) -> dict:
    rows = _rows(spark, input).where("status = 'object'")
    read = rows.select("line_no", "raw", extract.row_intent(F.col("raw"), domain).alias("intent"), extract.sampling_mode(F.col("raw")).alias("mode"))
    out = materialize(sampling.downsample(read, "line_no", target_intent, remove_count, seed=seed), "sampled")
    _write_raw(out.where("not removed"), output)
    if removed_output:
        _write_raw(out.where("removed"), removed_output)
    return out.agg(F.count("*").alias("rows"), F.count_if("removed").alias("removed")).first().asDict()


STAGES = {f.__name__: f for f in (dedup_final_prompt, reviewed_final_prompt, merge_tasks, data_stats, planner_step_sft, fix_intents, planner_final_prompt, merged_final_prompt, no_intent_executor, downsample)}
