"""Where artifacts of a task lie, what a file name says, and the run log."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.sources.jsonl import exists

# Artifact -> file name within its task.
FILES = {
    "planner_trajectories": "planner_trajectories.jsonl", "planner_step_sft": "planner_step_sft.jsonl", "planner_final_prompt": "planner_final_prompt.jsonl", "executor_answer": "executor_answer_sft.jsonl",
    "review_results": "review_results.jsonl", "review_rejected": "review_rejected.jsonl", "merged_final_prompt": "merged_final_prompt.jsonl", "reviewed_final_prompt": "reviewed_final_prompt.jsonl",
    "dedup_final_prompt": "dedup_final_prompt.jsonl", "duplicates": "duplicates.jsonl", "data_stats_md": "data_stats.md", "data_stats_json": "data_stats.json", "multiturn_sessions": "multiturn_sessions.jsonl",
    "multiturn_planner": "multiturn_planner_trajectories.jsonl", "multiturn_executor": "multiturn_executor_answers.jsonl", "identity_sft": "identity_sft.jsonl", "no_intent_executor": "executor_no_intent_sft.jsonl",
    "intent_downsampled": "intent_downsampled.jsonl", "intent_downsampled_removed": "intent_downsampled_removed.jsonl", "executor_downsampled": "executor_downsampled.jsonl", "executor_downsampled_removed": "executor_downsampled_removed.jsonl",
}
_BY_LENGTH = sorted(FILES.values(), key=len, reverse=True)


def safe_part(value: str | None, default: str) -> str:
    text = re.sub(r"[^\w.-]", "_", (value or "").strip() or default)
    return text.strip("._-") or default


def default_prefix(domain: str | None, split: str | None = None) -> str:
    return f"{safe_part(domain, 'health')}_{safe_part(split, 'train')}"


def artifact_path(spark: SparkSession, root: str, key: str, domain: str, task: str | None = None) -> str:
    """``root/domain/task/file``, or ``root/domain/task_file`` if only that older place has it."""
    place, name = f"{root.rstrip('/')}/{safe_part(domain, 'health')}", safe_part(task, default_prefix(domain))
    now, before = f"{place}/{name}/{FILES[key]}", f"{place}/{name}_{FILES[key]}"
    return before if not exists(spark, now) and exists(spark, before) else now


def classify(name: str) -> tuple[str, str] | None:
    """(task, file name) of an older name ``task_file``, backups included; the longest known file name counts."""
    for file in _BY_LENGTH:
        at = name.find(f"_{file}")
        if at > 0 and (name.endswith(f"_{file}") or name[at + 1 + len(file) : at + 2 + len(file)] == "."):
            return name[:at], name[at + 1 :]
    return None


def key_of(name: str) -> str | None:
    for key, file in sorted(FILES.items(), key=lambda kv: -len(kv[1])):
        if name == file or name.startswith(f"{file}."):
            return key
    return None


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """``(task, files, bytes, modified, names)`` of the tasks under a domain's folder, newest first. File contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime", "length")
    parts = F.split("path", "/")
    return (
        files.select(F.element_at(parts, -2).alias("task"), F.element_at(parts, -1).alias("name"), "modificationTime", "length")
        .groupBy("task")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"), F.sort_array(F.collect_set("name")).alias("names"))
        .orderBy(F.desc("modified"), "task")
    )


def latest_runs(records: DataFrame, order: str, limit: int = 20) -> DataFrame:
    """The last record of each run id, most recently started first."""
    last = records.groupBy("id").agg(F.max_by(F.struct(*(c for c in records.columns if c != "id")), F.col(order)).alias("r"))
    return last.select("id", "r.*").orderBy(F.desc(F.coalesce("startedAt", "createdAt"))).limit(limit)


def changed_files(before: DataFrame, after: DataFrame, key: str = "path") -> DataFrame:
    """``(key, status, grown)`` of two snapshots with sizes: added, removed, changed or same."""
    b, a = before.select(key, F.col("length").alias("old")), after.select(key, F.col("length").alias("new"))
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed").otherwise("same")
    return b.join(a, key, "full_outer").select(key, status.alias("status"), (F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0))).alias("grown"))
