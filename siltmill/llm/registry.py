"""Queries of the training-text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import decontam, langid, linedup, packing, quality, secrets, simhash, sql, tokencount, urlfilter, warc
from siltmill.sources.tables import table

RULES = (
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).withColumnRenamed("doc", "doc_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge_urls(pages, RULES).drop("url")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    written = F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")))
    of_kind = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("long")
    count = {k: of_kind(k) for k in secrets.KINDS}
    base = F.array_join(F.filter(written, lambda w: ~w.startswith("cnn:")), ",")
    return found.select(
        F.col("doc").alias("doc_id"), count["assign"].alias("n_assign"), count["access"].alias("n_access"), count["hex"].alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"), F.array_join(written, ",").alias("spans"), count["cnn"].alias("n_added"), "n_scored",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), simhash.hex_print(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder == 2, F.lit(True)))
    field = langid.train(docs.where(~F.col("held_out")))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))
    return langid.predict(docs, field).select(F.col("doc").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linedup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_quality, op2_packing, op3_urls, op4_warc, op5_secrets, op6_simhash, op7_language, op8_lines, op9_tokens, op10_leaks)
    return {f.__name__: f for f in (*ops, pipeline)}


def oracle_sql() -> dict[str, str]:
    seeds = decontam.Seeds()
    return {
        "op3_urls": sql.op3(RULES, urlfilter.VOCABULARY, urlfilter.STRICT, urlfilter.MIN_SOFT),
        "op4_warc": sql.OP4,
        "op8_lines": sql.OP8,
        "op10_leaks": sql.op10(seeds.masks, seeds.overlap, seeds.max_substitutions, seeds.phrase),
    }
