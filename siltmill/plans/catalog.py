"""Every query of the engine's own operators, with the SQL that states its result.

The tables of a data directory stand in for the artifacts: documents for text rows, labels for
reviews, conversations for chat sessions, orders with their line items for trajectories, events for
seeds. Each query reads its tables whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions import jsonx, lookups, nested, numbers, text
from siltmill.operators import dedup, merge, review, roles, sampling, sessions, stats, steps, teacher
from siltmill.sources import jsonl
from siltmill.sources.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay after near-duplicate removal."""
    docs = table(spark, sf_dir, "documents")
    return dedup.deduplicate(docs, "doc_id", "text").select("doc_id", "lang", "source", "n_chars")


# Text

_NORM = r"regexp_replace(lower(text), '[^\x{4e00}-\x{9fff}A-Za-z0-9]', '', 'g')"


@query(f"SELECT doc_id, {_NORM} AS norm, length({_NORM})::BIGINT AS norm_chars FROM documents")
def text_normalize(spark, sf_dir):
    norm = text.normalize(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", norm.alias("norm"), F.length(norm).cast("long").alias("norm_chars"))


@query(f"""
WITH n AS (SELECT doc_id, {_NORM} AS t FROM documents)
SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(length(t) - 1, 1)), lambda i: substr(t, i, 3))))::BIGINT AS n_grams FROM n""")
def char_ngrams(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.char_ngrams(F.col("text"), 3)).cast("long").alias("n_grams"))


_LENGTHS = """count(v)::BIGINT AS count, coalesce(min(v), 0)::BIGINT AS min, coalesce(max(v), 0)::BIGINT AS max, coalesce(avg(v), 0)::DOUBLE AS avg,
  quantile_disc(v, 0.5)::BIGINT AS p50, quantile_disc(v, 0.9)::BIGINT AS p90, quantile_disc(v, 0.95)::BIGINT AS p95, quantile_disc(v, 0.99)::BIGINT AS p99"""


@query(f"SELECT lang, {_LENGTHS} FROM (SELECT lang, length(coalesce(text, '')) AS v FROM documents) GROUP BY lang")
def doc_length_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("chars", text.text_length(F.col("text")))
    return stats.lengths(docs, "chars", ["lang"])


# Near-duplicates. Classes are rows with equal n-gram sets, under their smallest id.

_SETS = rf"""
WITH RECURSIVE n AS (
  SELECT doc_id, text, length(text) AS chars, {_NORM} AS t FROM documents
), g AS (
  SELECT doc_id, chars, CASE WHEN length(t) < 3 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)))) END AS grams FROM n
), s AS (
  SELECT min(doc_id) AS class, grams, len(grams) AS n FROM g WHERE len(grams) > 0 GROUP BY grams
), m AS (
  SELECT g.doc_id, g.chars, coalesce(s.class, g.doc_id) AS class FROM g LEFT JOIN s ON g.grams = s.grams
), e AS (
  SELECT class, n, unnest(grams) AS gram FROM s
), df AS (
  SELECT gram, count(*) AS df FROM e GROUP BY gram
), r AS (
  SELECT class, n, gram, row_number() OVER (PARTITION BY class ORDER BY df, gram) AS k FROM e JOIN df USING (gram)
), p AS (
  SELECT class, n, gram FROM r WHERE k <= n - ceil(n * 0.9 - 1e-9) + 1
), c AS (
  SELECT DISTINCT a.class AS l, b.class AS r FROM p a JOIN p b ON a.gram = b.gram AND a.class < b.class AND least(a.n, b.n) >= 0.9 * greatest(a.n, b.n) - 1e-9
), j AS (
  SELECT c.l, c.r, len(list_intersect(a.grams, b.grams)) AS i, a.n + b.n AS total FROM c JOIN s a ON a.class = c.l JOIN s b ON b.class = c.r
), pairs AS (
  SELECT l, r, i::DOUBLE / (total - i) AS jaccard FROM j WHERE i::DOUBLE / (total - i) >= 0.9
)"""


@query(_SETS + ' SELECT l AS "left", r AS "right", jaccard FROM pairs')
def dedup_exact_pairs(spark, sf_dir):
    _, sets = dedup.classes(table(spark, sf_dir, "documents"), "doc_id", "text")
    return dedup.similar_sets(sets)


_CLUSTERS = (
    _SETS
    + """, both_ways AS (
  SELECT l AS a, r AS b FROM pairs UNION SELECT r, l FROM pairs
), walk AS (
  SELECT DISTINCT class AS a, class AS b FROM m UNION SELECT w.a, x.b FROM walk w JOIN both_ways x ON w.b = x.a
), comp AS (
  SELECT a AS class, min(b) AS cluster FROM walk GROUP BY a
), k AS (
  SELECT m.doc_id AS idx, m.class, comp.cluster, m.chars FROM m JOIN comp USING (class)
)"""
)


@query(
    _CLUSTERS
    + """
SELECT idx, class, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size,
  row_number() OVER (PARTITION BY cluster ORDER BY chars DESC, idx) = 1 AS keep_longest,
  row_number() OVER (PARTITION BY cluster ORDER BY idx) = 1 AS keep_first,
  row_number() OVER (PARTITION BY cluster ORDER BY idx DESC) = 1 AS keep_last
FROM k"""
)
def dedup_clusters(spark, sf_dir):
    return dedup.representatives(dedup.cluster(table(spark, sf_dir, "documents"), "doc_id", "text"))


@query(
    _CLUSTERS
    + """, z AS (SELECT cluster, count(*) AS c FROM k GROUP BY cluster)
SELECT sum(c)::BIGINT AS input_rows, count(*) AS clusters, count(*) FILTER (c > 1) AS duplicate_clusters, sum(c - 1)::BIGINT AS removed_rows,
  count(*) AS output_rows, max(c) AS largest_cluster, sum(c - 1)::DOUBLE / sum(c) AS duplicate_ratio FROM z"""
)
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(dedup.cluster(table(spark, sf_dir, "documents"), "doc_id", "text"))


@query()
def dedup_minhash(spark, sf_dir):
    return dedup.cluster(table(spark, sf_dir, "documents"), "doc_id", "text", method="minhash")


# Reviews

_REVIEWED = """
WITH r AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'pass' ELSE 'reject' END AS said, 1 + toxic * 2 + quality * 2 AS score FROM labels
), v AS (
  SELECT doc_id, CASE WHEN said = 'pass' AND score < 4 THEN 'reject' ELSE said END AS decision FROM r
), o AS (
  SELECT d.doc_id AS id, CASE WHEN d.lang = 'fr' THEN 'planner_final' ELSE 'executor_answer' END AS merge_source,
    CASE WHEN v.decision = 'pass' THEN 'approved' WHEN v.decision IS NOT NULL THEN 'rejected' WHEN d.lang = 'fr' THEN 'approved' ELSE 'unmatched' END AS outcome
  FROM documents d LEFT JOIN v USING (doc_id)
)"""


def _reviews(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    said, score = F.when(F.col("quality") == 1, "pass").otherwise("reject"), 1 + F.col("toxic") * 2 + F.col("quality") * 2
    return labels.select(F.col("doc_id").alias("source_sample_id"), review.gate(said, score, 4).alias("decision"), F.col("doc_id").alias("row_idx"))


def _merged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), F.when(F.col("lang") == "fr", "planner_final").otherwise("executor_answer").alias("merge_source"))


@query(_REVIEWED + " SELECT id, merge_source, outcome FROM o")
def review_split(spark, sf_dir):
    return review.split(_merged(spark, sf_dir), _reviews(spark, sf_dir))


@query(
    _REVIEWED
    + """ SELECT (SELECT count(*) FROM v) AS reviews, count(*) FILTER (outcome = 'approved') AS approved,
  count(*) FILTER (outcome = 'rejected') AS rejected, count(*) FILTER (outcome = 'unmatched') AS unmatched FROM o"""
)
def review_stats(spark, sf_dir):
    reviews = _reviews(spark, sf_dir)
    return review.split_stats(review.split(_merged(spark, sf_dir), reviews), reviews)


# Merges. Documents, benchmark items and chat messages are three inputs, in this order.

_INPUTS = """
WITH i AS (
  SELECT 0 AS src, doc_id AS row_idx, doc_id::VARCHAR AS id, text FROM documents
  UNION ALL SELECT 1, item_id, item_id::VARCHAR, text FROM benchmark
  UNION ALL SELECT 2, conv_id * 1000 + turn, conv_id::VARCHAR, text FROM conversations
)"""


def _inputs(spark, sf_dir):
    def lines(name, idx, ident):
        rows = table(spark, sf_dir, name)
        return rows.select(idx.alias("row_idx"), F.to_json(F.struct(ident.cast("string").alias("id"), F.col("text"))).alias("raw"))

    chat = lines("conversations", F.col("conv_id") * 1000 + F.col("turn"), F.col("conv_id"))
    return [lines("documents", F.col("doc_id"), F.col("doc_id")), lines("benchmark", F.col("item_id"), F.col("item_id")), chat]


@query(_INPUTS + " SELECT src::BIGINT AS src, row_idx, row_number() OVER (PARTITION BY text ORDER BY src, row_idx) = 1 AS written FROM i")
def merge_tasks_auto(spark, sf_dir):
    return merge.merge_tasks(_inputs(spark, sf_dir)).select(F.col("src").cast("long").alias("src"), "row_idx", "written")


@query(_INPUTS + " SELECT src::BIGINT AS src, row_idx, row_number() OVER (PARTITION BY id ORDER BY src, row_idx) = 1 AS written FROM i")
def merge_tasks_id(spark, sf_dir):
    return merge.merge_tasks(_inputs(spark, sf_dir), dedup_by="id").select(F.col("src").cast("long").alias("src"), "row_idx", "written")


@query(
    _INPUTS
    + """, w AS (SELECT src, row_number() OVER (PARTITION BY text ORDER BY src, row_idx) = 1 AS written FROM i)
SELECT src::BIGINT AS src, count(*) AS read, count(*) FILTER (written) AS written, count(*) FILTER (NOT written) AS duplicated, 0::BIGINT AS invalid FROM w GROUP BY src"""
)
def merge_report(spark, sf_dir):
    return merge.merge_report(merge.merge_tasks(_inputs(spark, sf_dir))).withColumn("src", F.col("src").cast("long"))


@query("""
WITH h AS (SELECT DISTINCT text FROM conversations WHERE conv_id % 7 = 0),
d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, text FROM documents), b AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS i, text FROM benchmark),
c AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, text FROM conversations),
f0 AS (SELECT min(i) AS i, text FROM d WHERE text NOT IN (SELECT text FROM h) GROUP BY text), l0 AS (SELECT min(i) AS last FROM f0 WHERE i >= 29), w0 AS (SELECT * FROM f0 WHERE i <= coalesce((SELECT last FROM l0), i)),
f1 AS (SELECT min(i) AS i, text FROM b WHERE text NOT IN (SELECT text FROM h UNION SELECT text FROM w0) GROUP BY text), l1 AS (SELECT min(i) AS last FROM f1 WHERE i >= 29), w1 AS (SELECT * FROM f1 WHERE i <= coalesce((SELECT last FROM l1), i)),
f2 AS (SELECT min(i) AS i, text FROM c WHERE text NOT IN (SELECT text FROM h UNION SELECT text FROM w0 UNION SELECT text FROM w1) GROUP BY text), l2 AS (SELECT min(i) AS last FROM f2 WHERE i >= 29)
SELECT 0::BIGINT AS src, i AS row_idx, i IN (SELECT i FROM w0) AS written FROM d WHERE i <= coalesce((SELECT last FROM l0), i)
UNION ALL SELECT 1, i, i IN (SELECT i FROM w1) FROM b WHERE i <= coalesce((SELECT last FROM l1), i)
UNION ALL SELECT 2, i, i IN (SELECT i FROM f2) FROM c WHERE i <= coalesce((SELECT last FROM l2), i)""")
def merge_tasks_capped(spark, sf_dir):
    """What is read and written of each input up to its 30th row, into an output that holds some already: the cap is the feature."""
    def lines(name, *order):
        at = F.struct(F.lit(name).alias("file_path"), F.floor(F.col(order[0]) / 1000).alias("file_block_start"), F.struct(*order).alias("n"))
        rows = jsonl.numbered(table(spark, sf_dir, name).select(at.alias("row_idx"), F.to_json(F.struct("text")).alias("raw")))
        return rows.select(F.col("line_no").cast("long").alias("row_idx"), "raw")

    held = table(spark, sf_dir, "conversations").where("conv_id % 7 = 0").select(F.to_json(F.struct("text")).alias("raw"))
    sources = [lines("documents", "doc_id"), lines("benchmark", "item_id"), lines("conversations", "conv_id", "turn")]
    return merge.merge_tasks(sources, max_rows=30, existing=held).select(F.col("src").cast("long").alias("src"), "row_idx", "written")


@query("SELECT doc_id AS id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return merge.resume(docs, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")))


@query("SELECT min(conv_id * 1000 + turn) AS row_idx, text AS id FROM conversations GROUP BY text")
def first_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("text").alias("id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"))
    return merge.first_wins(rows, "id", "row_idx").select("id", "row_idx")


@query("""
SELECT event_id, 'planner_final' AS merge_source, coalesce(props ->> '$.k', '') AS source_id, coalesce(try_cast(props ->> '$.k' AS BIGINT), 0) AS step,
  coalesce(props ->> '$.k' NOT IN ('0', 'false', ''), false) AS planner_overridden FROM events""")
def metadata_schema(spark, sf_dir):
    raw = F.regexp_replace("props", '"k"', '"source_id"')
    raw = F.concat(F.regexp_replace(raw, r"\}\s*$", ""), F.lit(', "step": '), F.get_json_object("props", "$.k"), F.lit(', "planner_overridden": '), F.get_json_object("props", "$.k"), F.lit("}"))
    fixed = table(spark, sf_dir, "events").select("event_id", merge.fixed_metadata(raw, "planner_final").alias("m"))
    return fixed.select("event_id", "m.merge_source", "m.source_id", F.col("m.step").cast("long").alias("step"), "m.planner_overridden")


# Frequencies


@query("SELECT source AS value, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source")
def freq_first_seen(spark, sf_dir):
    return stats.frequencies(table(spark, sf_dir, "documents"), "source", "doc_id")


@query("SELECT value, n, first FROM (SELECT lang AS value, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY lang) ORDER BY n DESC, first LIMIT 2")
def topn(spark, sf_dir):
    return stats.frequencies(table(spark, sf_dir, "documents"), "lang", "doc_id", top=2)


@query("SELECT event_type AS value, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM events GROUP BY event_type")
def pct_distribution(spark, sf_dir):
    return stats.shares(table(spark, sf_dir, "events"), "event_type")


@query("""SELECT count(*) AS rows, count(text) AS ids, count(DISTINCT text) AS unique_ids, count(*) FILTER (text IS NULL) AS missing_id,
  count(text) - count(DISTINCT text) AS duplicate_ids FROM documents""")
def base_stats(spark, sf_dir):
    return stats.base_stats(table(spark, sf_dir, "documents"), "text")


# JSON


@query("""
SELECT event_id, props ->> '$.k' AS k, '{"k":' || (props ->> '$.k') || '}' AS canonical, 'unknown' AS row_type,
  CASE WHEN event_type = 'click' THEN '{"query":"click"}' ELSE '{"k":' || (props ->> '$.k') || '}' END AS args FROM events""")
def json_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    v = jsonx.parsed(F.col("props"))
    said = F.when(F.col("event_type") == "click", F.col("event_type")).otherwise(F.col("props"))
    return events.select("event_id", jsonx.field(v, "$.k").alias("k"), jsonx.canonical(F.col("props")).alias("canonical"), jsonx.row_type(F.col("props")).alias("row_type"), jsonx.arguments(said).alias("args"))


@query("""
SELECT count(*) AS total_lines, count(*) FILTER (event_type = 'view') AS blank_lines, count(*) FILTER (event_type IN ('click', 'error')) AS invalid_lines,
  count(*) FILTER (event_type IN ('signup', 'purchase')) AS json_rows FROM events""")
def json_invalid_count(spark, sf_dir):
    kind = F.col("event_type")
    raw = F.when(kind == "view", " \t").when(kind == "click", "[1, 2]").when(kind == "error", "oops {").otherwise(F.col("props"))
    return jsonl.accounting(jsonl.classify(table(spark, sf_dir, "events").select(raw.alias("raw"))))


# Sessions

_TURNS = """
WITH c AS (
  SELECT conv_id, turn, role, text, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), p AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n, text AS u, CASE WHEN nr = 'assistant' THEN nt END AS a FROM c WHERE role = 'user'
), l AS (
  SELECT *, '用户：' || trim(u, ' ' || chr(10)) || coalesce(chr(10) || '助手：' || trim(a, ' ' || chr(10)), '') AS line FROM p
)"""


def _turns(spark, sf_dir):
    return sessions.turns_of(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


@query(_TURNS + " SELECT conv_id, max(n) AS turns, count(*) FILTER (n > 2 AND k <= n - 2) AS older, count(*) FILTER (n <= 2 OR k > n - 2) AS recent FROM l GROUP BY conv_id")
def history_split(spark, sf_dir):
    older, recent = sessions.split_history(F.col("turns"), 2)
    size = lambda c: F.size(c).cast("long")
    return _turns(spark, sf_dir).select("conv_id", size(F.col("turns")).alias("turns"), size(older).alias("older"), size(recent).alias("recent"))


@query(_TURNS + " SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS dialogue FROM l GROUP BY conv_id")
def dialogue_render(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", text.render_dialogue(F.col("turns")).alias("dialogue"))


@query(
    _TURNS
    + """, h AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY k) FILTER (n > 2 AND k <= n - 2) AS c, string_agg(line, chr(10) ORDER BY k) FILTER (n <= 2 OR k > n - 2) AS r FROM l GROUP BY conv_id
) SELECT conv_id, concat_ws(chr(10) || chr(10), '【压缩历史对话】' || chr(10) || c, '【近期历史对话】' || chr(10) || r) AS context FROM h"""
)
def history_context(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", sessions.context(F.col("turns"), 2).alias("context"))


@query(_TURNS + ", s AS (SELECT conv_id, max(n) AS n FROM l GROUP BY conv_id) SELECT conv_id, CASE WHEN n >= 2 THEN range(2, n + 1, 2) ELSE [] END AS points FROM s")
def compress_trigger(spark, sf_dir):
    points = sessions.compression_points(F.col("turns"), recent=1, every=2)
    return _turns(spark, sf_dir).select("conv_id", F.transform(points, lambda p: p.cast("long")).alias("points"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3 AS is_recent FROM conversations")
def recent_messages(spark, sf_dir):
    return sessions.recent_by_window(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", "turn", "is_recent")


_PROMPT = "SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS prompt FROM conversations GROUP BY conv_id"


def _messages(spark, sf_dir):
    one = F.struct("turn", "role", F.col("text").alias("content"))
    listed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("m"))
    none = F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls")
    return listed.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), none)).alias("messages"))


def _prompts(spark, sf_dir):
    return _messages(spark, sf_dir).select("conv_id", text.chatml(F.col("messages")).alias("prompt"))


@query(_PROMPT)
def chatml_render(spark, sf_dir):
    return _prompts(spark, sf_dir)


@query("""
WITH u AS (SELECT conv_id, arg_max(text, turn) AS t FROM conversations WHERE role = 'user' GROUP BY conv_id),
c AS (SELECT conv_id, count(*) FILTER (role = 'assistant') AS n FROM conversations GROUP BY conv_id)
SELECT c.conv_id, coalesce(trim(u.t, ' ' || chr(10)), '') AS last_user, c.n AS assistant_turns FROM c LEFT JOIN u USING (conv_id)""")
def last_user_turn(spark, sf_dir):
    p = F.col("prompt")
    return _prompts(spark, sf_dir).select("conv_id", text.last_turn(p, text.USER).alias("last_user"), text.occurrences(p, text.ANY_ASSISTANT).alias("assistant_turns"))


@query(f"""
WITH p AS ({_PROMPT})
SELECT conv_id, contains(prompt, '<|im_start|>system') AS has_system, contains(prompt, '<|im_start|>user') AS has_user, contains(prompt, '<|im_start|>assistant') AS has_assistant,
  contains(prompt, '<|im_start|>tool') OR contains(prompt, '<|im_start|>function') AS has_tool, contains(prompt, '<think>') AS has_think,
  contains(prompt, '# Tools') OR contains(prompt, '<tools>') AS has_tool_schema FROM p""")
def section_flags(spark, sf_dir):
    return _prompts(spark, sf_dir).select("conv_id", *(c.alias(k) for k, c in text.section_flags(F.col("prompt")).items()))


@query("""
WITH c AS (SELECT conv_id, count(*) AS m, sum(length(text)) AS chars, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS own FROM conversations GROUP BY conv_id)
SELECT count(*) AS rows, sum(m)::BIGINT AS messages, sum(chars)::BIGINT AS chars, quantile_disc(chars, 0.9)::BIGINT AS chars_p90, quantile_disc(own, 0.5)::BIGINT AS own_p50 FROM c""")
def message_stats(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    found = stats.message_stats(messages)
    total = messages.agg(F.sum(F.size("messages")).alias("messages"), F.sum(F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))).alias("chars"))
    return found.crossJoin(total).select("rows", "messages", "chars", F.col("message_content_chars.p90").alias("chars_p90"), F.col("assistant_content_chars.p50").alias("own_p50"))  # one row each


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def role_counts(spark, sf_dir):
    return stats.role_counts(_messages(spark, sf_dir))


@query("""
SELECT conv_id, turn, 'reason ' || role AS reasoning, trim(text, ' ' || chr(10)) AS answer FROM conversations""")
def strip_think(spark, sf_dir):
    wrapped = F.concat(F.lit("<think>\nreason "), F.col("role"), F.lit("\n</think>\n"), F.col("text"))
    reasoning, answer = text.split_reasoning(wrapped)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", reasoning.alias("reasoning"), answer.alias("answer"))


# Trajectories: an order is a row, its line items are steps

_ACTION = "CASE WHEN l_linestatus = 'O' THEN 'tool_call' WHEN l_returnflag = 'A' THEN 'ask_clarification' ELSE 'planning_finish' END"
_STEPS = f"""
WITH s AS (
  SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, l_linenumber AS step, {_ACTION} AS action,
    l_returnflag AS flag, l_partkey AS part, l_suppkey AS supp, l_quantity AS q FROM lineitem
)"""


def _trajectories(spark, sf_dir):
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    action = F.when(status == "O", "tool_call").when(flag == "A", "ask_clarification").otherwise("planning_finish")
    calls = F.when(action == "tool_call", F.array(F.struct(F.lit("c").alias("id"), F.when(F.col("l_quantity") >= 49, "write_file").otherwise(F.concat(F.lit("tool_"), flag)).alias("name"), F.lit("{}").alias("arguments"))))
    seen = F.when(action == "tool_call", F.array(F.struct(F.lit("c").alias("tool_call_id"), F.concat(F.lit("tool_"), flag).alias("name"), F.col("l_partkey").cast("string").alias("content"), (flag == "R").alias("error"))))
    output = F.struct(
        F.when(flag == "A", "运动功法").when(flag == "R", "其他").alias("intent"), action.alias("action"), F.col("l_suppkey").cast("string").alias("ask"), F.lit("done").alias("finish_reason"),
        F.coalesce(calls, F.array()).cast(f"array<{nested.CALL}>").alias("tool_calls"),
    )
    step = F.struct(
        F.col("l_linenumber").cast("int").alias("step"), output.alias("planner_output"), F.struct(F.lit(None).cast("string").alias("reasoning_content"), F.lit("").alias("raw_content"), F.lit("").alias("content")).alias("planner_raw_output"),
        F.lit(False).alias("planner_overridden"), F.coalesce(seen, F.array()).cast(f"array<{nested.OBSERVATION}>").alias("observations"),
    ).cast(nested.STEP)
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.struct(*order, step.alias("step")).alias("s"))
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list("s"), lambda a, b: _by(a, b, order)), lambda x: x["step"]).alias("steps"))


def _by(a, b, names):
    out = F.lit(0)
    for n in reversed(names):
        out = F.when(a[n] < b[n], -1).when(a[n] > b[n], 1).otherwise(out)
    return out


@query(
    _STEPS
    + """, f AS (SELECT id, min(k) FILTER (action = 'tool_call' AND q >= 49) AS bad FROM s GROUP BY id),
h AS (
  SELECT *, 2 + coalesce(sum(CASE WHEN action = 'tool_call' THEN 2 ELSE 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    lag(action) OVER w AS pa, lag(flag) OVER w AS pf, lag(supp) OVER w AS ps FROM s WINDOW w AS (PARTITION BY id ORDER BY k)
)
SELECT h.id::VARCHAR || '_step_' || h.step AS id, h.action,
  (before + CASE WHEN action <> 'tool_call' AND pa = action AND pf = flag AND (action = 'planning_finish' OR ps = supp) THEN 0 ELSE 1 END)::BIGINT AS n_messages
FROM h JOIN f USING (id) WHERE f.bad IS NULL OR h.k < f.bad"""
)
def step_explode(spark, sf_dir):
    rows = _trajectories(spark, sf_dir).withColumns({"domain": F.lit("d"), "user_query": F.col("id").cast("string")})
    return steps.explode_steps(rows, "system").select("id", "metadata.action", F.size("messages").cast("long").alias("n_messages"))


@query(
    _STEPS
    + """, w AS (SELECT id, arg_max(CASE flag WHEN 'A' THEN '运动指导' WHEN 'R' THEN '其他' END, k) FILTER (flag IN ('A', 'R')) AS intent FROM s GROUP BY id),
a AS (SELECT id, arg_max(supp::VARCHAR, k) AS ask FROM s WHERE action = 'ask_clarification' GROUP BY id),
o AS (SELECT id, k, flag, part, row_number() OVER (PARTITION BY id ORDER BY k) AS i FROM s WHERE action = 'tool_call'),
x AS (SELECT id, string_agg('【' || i || '. tool_' || flag || CASE WHEN flag = 'R' THEN '（工具失败）' ELSE '' END || '】' || chr(10) || part, chr(10) || chr(10) ORDER BY i) AS info, bool_or(flag = 'R') AS failed FROM o GROUP BY id),
n AS (SELECT id, list('tool_' || flag ORDER BY f) AS names FROM (SELECT id, flag, min(k) AS f FROM o GROUP BY id, flag) GROUP BY id)
SELECT w.id, coalesce(w.intent, '其他') AS intent, a.ask AS clarification_ask, coalesce(x.info, '无外部补充信息。') AS external_info, coalesce(n.names, []) AS tool_names, coalesce(x.failed, false) AS has_tool_error
FROM w LEFT JOIN a USING (id) LEFT JOIN x USING (id) LEFT JOIN n USING (id)"""
)
def executor_context(spark, sf_dir):
    rows = _trajectories(spark, sf_dir).withColumn("expected_intent", F.lit(None).cast("string"))
    return steps.executor_context(rows, lookups.resolve(lookups.HEALTH, with_default=False)).withColumn("intent", F.coalesce("intent", F.lit("其他"))).drop("steps", "expected_intent")


@query(
    _STEPS
    + """, z AS (SELECT id, max(k) AS last, arg_max(CASE flag WHEN 'A' THEN '运动指导' END, k) AS x, arg_max(flag, k) AS lf FROM s GROUP BY id)
SELECT s.id, count(*) FILTER (z.lf = 'A' AND s.k < z.last AND s.action = 'tool_call' AND s.flag <> 'A') AS changed_steps FROM s JOIN z USING (id) GROUP BY s.id"""
)
def backfill_intent(spark, sf_dir):
    return steps.repair_intents(_trajectories(spark, sf_dir), lookups.resolve(lookups.HEALTH)).select("id", "changed_steps")


@query(
    _STEPS
    + """, t AS (SELECT id, count(*) AS n, count(*) FILTER (action = 'tool_call') AS calls, count(*) FILTER (action = 'ask_clarification') AS asks, bool_or(action = 'tool_call' AND q >= 49) AS bad,
  bool_or(action = 'tool_call' AND flag = 'R') AS failed, arg_max(action, k) = 'tool_call' AS ends FROM s GROUP BY id)
SELECT count(*) AS rows, sum(n)::BIGINT AS total_steps, sum(calls)::BIGINT AS total_tool_calls, count(*) FILTER (calls > 0) AS rows_with_tool_call, count(*) FILTER (failed) AS rows_with_tool_error,
  sum(asks)::BIGINT AS rows_with_ask, count(*) FILTER (bad) AS rows_with_forbidden_tool_call, count(*) FILTER (ends) AS final_tool_call, quantile_disc(n, 0.9)::BIGINT AS length_p90 FROM t"""
)
def trajectory_stats(spark, sf_dir):
    rows = _trajectories(spark, sf_dir).withColumns({"tool_sampling_mode": F.lit("normal"), "user_query": F.col("id").cast("string")})
    names = ["rows", "total_steps", "total_tool_calls", "rows_with_tool_call", "rows_with_tool_error", "rows_with_ask", "rows_with_forbidden_tool_call", "final_tool_call"]
    return stats.trajectory_stats(rows).select(*names, F.col("trajectory_length.p90").alias("length_p90"))


_PAYLOAD = """'{"intent": ' || CASE flag WHEN 'A' THEN '"运动功法"' WHEN 'R' THEN '"其他"' ELSE 'null' END || ', "action": "' || action || '"' ||
    CASE action WHEN 'ask_clarification' THEN ', "ask": "' || supp || '"' WHEN 'planning_finish' THEN ', "finish_reason": "done"' ELSE '' END || '}'"""


@query(
    _STEPS
    + f""", f AS (SELECT id, min(k) FILTER (action = 'tool_call' AND q >= 49) AS bad FROM s GROUP BY id),
c AS (SELECT *, {_PAYLOAD} AS payload FROM s),
h AS (
  SELECT *, string_agg(payload || CASE WHEN action = 'tool_call' THEN ' | ' || part ELSE '' END, ' | ') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    lag(action) OVER w AS pa, lag(payload) OVER w AS pp FROM c WINDOW w AS (PARTITION BY id ORDER BY k)
)
SELECT h.id::VARCHAR || '_step_' || h.step AS id,
  concat_ws(' | ', 'be brief', h.id, before, CASE WHEN action <> 'tool_call' AND coalesce(pa <> 'tool_call' AND pp = payload, false) THEN NULL ELSE payload END) AS contents,
  CASE WHEN h.id % 3 = 0 THEN 'catalogued' WHEN h.id % 3 = 1 THEN 'search' ELSE '' END AS tools
FROM h JOIN f USING (id) WHERE f.bad IS NULL OR h.k < f.bad"""
)
def step_contents(spark, sf_dir):
    """What the messages of each sample say, and which tools it exposes: all, those named, or the catalogue's."""
    tool = lambda n: f'{{"type": "function", "function": {{"name": "{n}"}}}}'
    kind = F.col("id") % 3
    raw = F.when(kind == 0, "{}").when(kind == 1, f'{{"tools": [{tool("search")}, {tool("write_file")}]}}').otherwise('{"tools": []}')
    rows = _trajectories(spark, sf_dir).withColumns({"domain": F.lit("d"), "user_query": F.col("id").cast("string"), "tools": nested.exposed_tools(raw, f"[{tool('catalogued')}]")})
    made = steps.explode_steps(rows, "be brief", tools="tools")
    names = F.transform("tools", lambda t: F.try_variant_get(t, "$.function.name", "string"))
    return made.select("id", F.array_join(F.transform("messages", lambda m: m["content"]), " | ").alias("contents"), F.array_join(names, ",").alias("tools"))


@query(
    _STEPS
    + """, z AS (SELECT id, max(k) AS last, arg_max(flag, k) AS lf FROM s GROUP BY id),
c AS (SELECT s.*, z.lf = 'A' AND s.k < z.last AND s.action = 'tool_call' AND s.flag <> 'A' AS fixed FROM s JOIN z USING (id))
SELECT id, count(*) FILTER (fixed) AS backfilled,
  string_agg(CASE WHEN fixed THEN '运动指导' WHEN flag = 'A' THEN '运动功法' WHEN flag = 'R' THEN '其他' ELSE 'null' END, ',' ORDER BY k) AS intents,
  string_agg(CASE WHEN fixed THEN '{"intent": "运动指导", "action": "tool_call"}' ELSE '' END, ',' ORDER BY k) AS contents
FROM c GROUP BY id"""
)
def repaired_rows(spark, sf_dir):
    """The rows that back-filling leaves, read back from their JSON."""
    known = lookups.resolve(lookups.HEALTH)
    rows = _trajectories(spark, sf_dir).withColumn("raw", F.to_json(F.struct("id", F.col("steps").alias("trajectory"))))
    changed = nested.backfilled(F.col("steps"), nested.backfill(F.col("steps"), known))
    final = known(F.try_element_at("steps", F.lit(-1))["planner_output"]["intent"])
    fixed = rows.select("id", roles.repaired(F.col("raw"), changed, final, lookups.HEALTH).alias("raw"))
    after = nested.read_steps(F.get_json_object("raw", "$.trajectory"))
    say = lambda f: F.array_join(F.transform(after, f), ",")
    return fixed.select(
        "id", F.coalesce(F.get_json_object("raw", "$.empty_tool_call_intent_backfill_count").cast("long"), F.lit(0)).alias("backfilled"),
        say(lambda x: F.coalesce(x["planner_output"]["intent"], F.lit("null"))).alias("intents"), say(lambda x: x["planner_raw_output"]["content"]).alias("contents"),
    )


# Rows of the executor and the reviewer, with teachers that answer by rule


def _as_lines(rows, raw):
    return rows.select(F.monotonically_increasing_id().alias("line_no"), raw.alias("raw"))


@query(
    _STEPS
    + """, w AS (SELECT id, arg_max(CASE flag WHEN 'A' THEN '运动指导' WHEN 'R' THEN '其他' END, k) FILTER (flag IN ('A', 'R')) AS intent FROM s GROUP BY id),
a AS (SELECT id, arg_max(supp::VARCHAR, k) AS ask FROM s WHERE action = 'ask_clarification' GROUP BY id),
o AS (SELECT id, k, flag, part, row_number() OVER (PARTITION BY id ORDER BY k) AS i FROM s WHERE action = 'tool_call' AND flag <> 'R'),
x AS (SELECT id, string_agg('【' || i || '. tool_' || flag || '】' || chr(10) || part, chr(10) || chr(10) ORDER BY i) AS info FROM o GROUP BY id),
r AS (SELECT w.id, coalesce(w.intent, '其他') AS intent, a.ask, coalesce(x.info, '无外部补充信息。') AS info FROM w LEFT JOIN a USING (id) LEFT JOIN x USING (id)),
m AS (
  SELECT *, concat_ws(chr(10) || chr(10), '【用户问题】' || chr(10) || 'order ' || id, '【识别意图】' || chr(10) || intent, '【规划阶段追问建议】' || chr(10) || ask, '【外部参考信息】' || chr(10) || info,
    '【近期历史对话】' || chr(10) || '用户：hello' || chr(10) || '助手：again') AS content FROM r
)
SELECT id || '_executor' AS id, id::VARCHAR AS source_id, intent, ask AS clarification_ask, info AS external_info, content AS asked,
  '<think>' || chr(10) || 'plan' || chr(10) || '</think>' || chr(10) || length(content) || ' characters' AS answer, ask IS NOT NULL AS has_clarification_ask
FROM m"""
)
def executor_rows(spark, sf_dir):
    history = F.array(F.struct(F.lit(" hello ").alias("user"), F.lit("again").alias("response")))
    rows = _trajectories(spark, sf_dir)
    rows = _as_lines(rows, F.to_json(F.struct("id", F.concat(F.lit("order "), "id").alias("user_query"), F.col("steps").alias("trajectory"), history.alias("dialogue_history"))))
    asked = roles.executor_requests(rows, lookups.HEALTH, "be brief", errors=False)
    said = teacher.ask(asked, "request", _counts_characters)
    made = roles.executor_rows(said, lookups.HEALTH, errors=False)
    at = lambda k: F.element_at("messages", k)["content"]
    return made.select("id", "source_id", "intent", "clarification_ask", "external_info", at(-2).alias("asked"), at(-1).alias("answer"), "metadata.has_clarification_ask")


def _counts_characters(request: dict) -> dict:
    return {"reasoning_content": "plan", "content": f"{len(request['messages'][-1]['content'])} characters"}


@query("""
WITH d AS (SELECT doc_id, left(trim(text, ' ' || chr(10) || chr(9) || chr(13)), 200) AS answer FROM documents WHERE trim(text, ' ' || chr(10) || chr(9) || chr(13)) <> ''),
s AS (SELECT *, 1 + length(rtrim(answer, ' ' || chr(10) || chr(9) || chr(13))) % 5 AS score FROM d)
SELECT 'd' || doc_id || '_reviewer' AS id, 'd' || doc_id AS source_sample_id, CASE WHEN score >= 4 THEN 'pass' ELSE 'reject' END AS decision, score::BIGINT AS score,
  CASE WHEN score < 2 THEN 'short: too short' ELSE '' END AS issues, length(answer)::BIGINT AS reviewed_answer_chars FROM s""")
def review_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(text.strip(F.col("text")) != "")
    answer = F.array(F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content")))
    rows = _as_lines(docs, F.to_json(F.struct(F.concat(F.lit("d"), "doc_id").alias("id"), F.lit("q").alias("user_query"), answer.alias("messages"))))
    done = roles.reviewed(roles.review_requests(rows, lookups.HEALTH, "be strict", 200), _scores_by_length, 1)
    issues = F.array_join(F.transform("issues", lambda i: F.concat(i["type"], F.lit(": "), i["message"])), ",")
    return roles.review_rows(done, 4).select("id", "source_sample_id", "decision", "score", issues.alias("issues"), "metadata.reviewed_answer_chars")


def _scores_by_length(request: dict) -> dict:
    answer = request["messages"][-1]["content"].split("【执行阶段回答】\n", 1)[1]
    score = 1 + len(answer) % 5
    issues = [{"type": " short", "message": "too short "}] if score < 2 else []
    return {"content": json.dumps({"decision": "pass" if score > 2 else "reject", "score": score, "issues": issues, "suggestions": []})}


@query("""
WITH p AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS body, arg_min(role, turn) AS lead, arg_min(text, turn) AS said FROM conversations GROUP BY conv_id),
a AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS n FROM p WHERE conv_id % 2 = 0 QUALIFY n <= 20),
e AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS n FROM p WHERE conv_id NOT IN (SELECT conv_id FROM a) QUALIFY n <= 30),
s AS (SELECT *, '<|im_start|>system' || chr(10) || 'house rules<|im_end|>' || chr(10) AS rules FROM p)
SELECT 'c' || conv_id AS id, 'planner_final' AS merge_source, body AS prompt, '' AS domain, '' AS intent, false AS has_clarification_ask, '' AS prompt_source FROM s WHERE conv_id IN (SELECT conv_id FROM a)
UNION ALL
SELECT 'c' || conv_id, 'executor_answer',
  CASE WHEN conv_id % 3 = 0 THEN body WHEN lead = 'system' THEN rules || substr(body, length('<|im_start|>system' || chr(10) || said || '<|im_end|>' || chr(10)) + 1) ELSE rules || body END,
  CASE WHEN conv_id % 3 = 0 THEN 'health' ELSE 'shop' END, 'buy', conv_id % 5 = 0, CASE WHEN conv_id % 3 = 0 THEN 'executor_messages' ELSE 'domain' END
FROM s WHERE conv_id IN (SELECT conv_id FROM e)""")
def merged_prompts(spark, sf_dir):
    """20 of the even sessions as planner prompts, then 30 of those left, with their domain's system prompt: the limits are the feature."""
    chat = _messages(spark, sf_dir)
    plan = chat.where("conv_id % 2 = 0").select(F.col("conv_id").alias("line_no"), F.concat(F.lit("c"), "conv_id").alias("id"), text.chatml(F.col("messages")).alias("prompt"))
    first, _ = merge.add_new(plan, None, "line_no", 20, F.col("prompt") != "")
    domain = F.when(F.col("conv_id") % 3 != 0, "shop").otherwise("elsewhere")
    ask = F.when(F.col("conv_id") % 5 == 0, "which?")
    said = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    rows = chat.select(F.col("conv_id").alias("line_no"), F.to_json(F.struct(F.concat(F.lit("c"), "conv_id").alias("id"), domain.alias("domain"), ask.alias("clarification_ask"), F.lit("buy").alias("intent"), said.alias("messages"))).alias("raw"))
    raw = F.col("raw")
    rows = rows.withColumn("id", roles.row_id(raw, F.col("line_no"), "executor_line"))
    second, _ = merge.add_new(rows, first.select("id"), "line_no", 30, roles.truthy(raw, "messages").isNotNull())
    system = F.when(F.get_json_object(raw, "$.domain") == "shop", "house rules")
    extra = {
        "domain": F.when(system.isNotNull(), "shop").otherwise("health"), "intent": F.get_json_object(raw, "$.intent"), "has_clarification_ask": F.get_json_object(raw, "$.clarification_ask").isNotNull(),
        "executor_assembly_system_prompt_source": F.when(system.isNotNull(), "domain").otherwise("executor_messages"),
    }
    parts = [
        first.select("id", "prompt", merge.fixed_metadata(F.lit("{}"), "planner_final").alias("m")),
        second.select("id", roles.rendered(raw, system).alias("prompt"), merge.fixed_metadata(F.lit("{}"), "executor_answer", extra=extra).alias("m")),
    ]
    return parts[0].unionByName(parts[1]).select("id", "m.merge_source", "prompt", "m.domain", "m.intent", "m.has_clarification_ask", F.col("m.executor_assembly_system_prompt_source").alias("prompt_source"))


# Quotas. Which rows are drawn is this engine's own choice; how many is fixed.


@query("""
WITH e AS (SELECT CASE event_type WHEN 'signup' THEN 'no_tools' WHEN 'view' THEN 'irrelevant_tools' END AS asked FROM events),
n AS (SELECT count(*) AS n, count(*) FILTER (asked = 'no_tools') AS a, count(*) FILTER (asked = 'irrelevant_tools') AS b FROM e),
q AS (SELECT *, least(greatest(0, floor(n * 0.3 + 0.5)::BIGINT - a), n - a - b) AS x FROM n),
r AS (SELECT *, least(greatest(0, floor(n * 0.25 + 0.5)::BIGINT - b), n - a - b - x) AS y FROM q),
t AS (SELECT n, a + x AS none, b + y AS other, n - a - x - b - y AS normal FROM r)
SELECT none AS no_tools, other AS irrelevant_tools, normal, least(n - none, floor(n * 0.1 + 0.5)::BIGINT) AS failing, 0::BIGINT AS failing_no_tools FROM t""")
def mode_quota_counts(spark, sf_dir):
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(kind == "signup", "a no_tool case").when(kind == "view", "irrelevant_tools here").alias("scenario"))
    out = sampling.assign_controls(rows, "event_id", 0.3, 0.25, 0.1)
    mode, fails = F.col("tool_sampling_mode"), F.col("tool_failure_enabled")
    return out.agg(
        F.count_if(mode == "no_tools").alias("no_tools"), F.count_if(mode == "irrelevant_tools").alias("irrelevant_tools"), F.count_if(mode == "normal").alias("normal"),
        F.count_if(fails).alias("failing"), F.count_if(fails & (mode == "no_tools")).alias("failing_no_tools"),
    )


@query("""
WITH t AS (SELECT lang, CASE WHEN source = 'src1' THEN 'no_tools' WHEN source = 'src2' THEN 'irrelevant_tools' ELSE 'normal' END AS mode FROM documents)
SELECT lang, mode, count(*) AS n, (CASE WHEN lang <> 'en' THEN 0 WHEN mode = 'no_tools' THEN 3 WHEN mode = 'irrelevant_tools' THEN 1 ELSE 6 END)::BIGINT AS removed FROM t GROUP BY lang, mode""")
def downsample_counts(spark, sf_dir):
    mode = F.when(F.col("source") == "src1", "no_tools").when(F.col("source") == "src2", "irrelevant_tools").otherwise("normal")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", mode.alias("mode"))
    return sampling.downsample(rows, "doc_id", "en", 10, intent="lang").groupBy("lang", "mode").agg(F.count("*").alias("n"), F.count_if("removed").alias("removed"))


# Lookups and tools

_DOMAIN = lookups.Domain(
    intents=("buy", "look", "trouble", "other"), aliases={"purchase": "buy", "click": "look", "view": "look", "error": "trouble"}, default_intent="other",
    tools=("cart", "search", "status", "help"), intent_tools={"buy": ("cart", "status")}, scenario_tools={"9": ("search", "unknown"), "99": ("cart",)}, default_tools=("help",),
)


@query("""
SELECT event_id, coalesce(CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'look' WHEN 'view' THEN 'look' WHEN 'error' THEN 'trouble' END, 'other') AS intent FROM events""")
def alias_resolve(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", lookups.resolve(_DOMAIN, with_default=True)(F.col("event_type")).alias("intent"))


@query("""
WITH t AS (
  SELECT event_id, list_concat(CASE WHEN event_type = 'purchase' THEN ['cart', 'status'] ELSE [] END, CASE WHEN contains(props, '9') THEN ['search'] ELSE [] END,
    CASE WHEN contains(props, '99') AND event_type <> 'purchase' THEN ['cart'] ELSE [] END) AS t FROM events
) SELECT event_id, CASE WHEN len(t) > 0 THEN t ELSE ['help'] END AS tools FROM t""")
def required_tools(spark, sf_dir):
    intent = lookups.resolve(_DOMAIN)(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", lookups.required_tools(_DOMAIN, [], intent, F.col("props")).alias("tools"))


@query("""
SELECT p_partkey, round(b, 9) AS bmi, CASE WHEN b < 18.5 THEN '偏瘦' WHEN b < 24 THEN '正常' WHEN b < 28 THEN '超重' ELSE '肥胖' END AS category,
  w * CASE WHEN p_size < 10 THEN 30 WHEN p_size > 40 THEN 40 ELSE 35 END AS water_ml, floor((220 - p_size) * CASE WHEN p_size < 10 THEN 0.5 WHEN p_size > 40 THEN 0.75 ELSE 0.6 END::DOUBLE)::BIGINT AS low,
  ceil((220 - p_size) * CASE WHEN p_size < 10 THEN 0.6 WHEN p_size > 40 THEN 0.85 ELSE 0.75 END::DOUBLE)::BIGINT AS high
FROM (SELECT *, 40.0::DOUBLE + p_size AS w, (40.0::DOUBLE + p_size) / ((150.0::DOUBLE + p_size) / 100) / ((150.0::DOUBLE + p_size) / 100) AS b FROM part)""")
def body_numbers(spark, sf_dir):
    size = F.col("p_size")
    weight, height, level = size + 40.0, size + 150.0, F.when(size < 10, "low").when(size > 40, "high").otherwise("moderate")
    b = numbers.bmi(weight, height)
    low, high = numbers.heart_rate_zone(size, level)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(b, 9).alias("bmi"), numbers.bmi_category(b).alias("category"), numbers.daily_water_ml(weight, level).alias("water_ml"), low.alias("low"), high.alias("high"))
