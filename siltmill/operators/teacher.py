"""Model and tool calls: injected Python callables over partitions, with retries.

A teacher is ``(request: dict) -> dict``. It runs inside ``mapInPandas``, one partition per task, so a
cluster calls as many at once as it has cores, and a lost task is simply asked again. Rows that fail
after all retries come back with an error and don't stop the job; ``Fatal`` does.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltmill.scratch import materialize
from siltmill.ship import ship


class Fatal(RuntimeError):
    """An error no retry can mend (a refused key, an exhausted quota): it fails the job."""


def backoff(attempt: int, cap: float = 20.0) -> float:
    return min(2.0**attempt, cap) + 1


def call(teacher: Callable[[dict], dict], request: dict, retries: int = 5, sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, str | None]:
    """(answer, error)."""
    error = None
    for attempt in range(max(1, retries)):
        try:
            return teacher(request), None
        except Fatal:
            raise
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < retries:
                sleep(backoff(attempt))
    return None, error


def ask(rows: DataFrame, request: str, teacher: Callable[[dict], dict], retries: int = 5) -> DataFrame:
    """``rows`` with ``answer`` (JSON text) and ``error``; ``request`` is a column of JSON text."""
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField("answer", StringType()), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only the request becomes Python objects; nested columns pass by.
        for b in batches:
            found = [call(teacher, json.loads(r), retries) for r in b.column(names.index(request)).to_pylist()]
            made = [[None if a is None else json.dumps(a, ensure_ascii=False) for a, _ in found], [e for _, e in found]]
            fields = [*b.schema, pa.field("answer", pa.string()), pa.field("error", pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(m, pa.string()) for m in made)], schema=pa.schema(fields))

    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def ask_until(rows: DataFrame, request: Callable[[int], Column], teacher: Callable[[dict], dict], reason: Column, attempts: int = 3, retries: int = 5) -> tuple[DataFrame, dict[str, int]]:
    """Rows with the first ``answer`` against which ``reason`` has nothing, and how often it had something.

    ``request`` gives the request of an attempt, from 0; ``reason`` reads the column ``answer`` and is null for a good one.
    Rows that stay without a good answer are left out.
    """
    pending, parts, counts = rows, [], {}
    for k in range(max(1, attempts)):
        said = ask(pending.withColumn("__request", request(k)), "__request", teacher, retries)
        judged = materialize(said.withColumn("__why", F.when(F.col("answer").isNull(), "no_answer").otherwise(reason)).drop("__request", "error"), "asked")
        parts.append(judged.where("__why is null").drop("__why"))
        bad = judged.where("__why is not null")
        for r in bad.groupBy("__why").count().collect():  # a handful of reasons
            counts[r["__why"]] = counts.get(r["__why"], 0) + r["count"]
        pending = bad.drop("answer", "__why")
        if not sum(r["count"] for r in bad.groupBy().count().collect()):
            break
    return reduce(DataFrame.unionByName, parts), counts


def converse(rows: DataFrame, planner: Callable[[dict], dict], simulator: Callable[[dict], dict], compress: Callable[[str], str], max_turns: int = 3, min_turns: int = 2, recent: int = 3, every: int = 2) -> DataFrame:
    """``(id, turns, compressed)``: whole sessions, each run in one task; ``turns`` is JSON text.

    ``rows`` has ``id`` and ``user_query``. A session ends after ``max_turns``, or when the simulator stops
    after ``min_turns`` or says nothing. History older than ``recent`` turns is compressed every ``every`` turns.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, query in zip(b["id"], b["user_query"], strict=True):
                turns, compressed, last = [], None, 0
                query = (query or "").strip()
                for n in range(1, max_turns + 1):
                    if not query:
                        break
                    answer, error = call(planner, {"id": i, "query": query, "history": turns[-recent:], "compressed": compressed}, 1)
                    if error:
                        break
                    turns.append({"user": query, "assistant": answer.get("text", "")})
                    if n == max_turns:
                        break
                    if n > recent and every > 0 and n - last >= every:
                        compressed, last = compress("\n".join(f"{t['user']}\n{t['assistant']}" for t in turns[:-recent])), n
                    said = simulator({"id": i, "turns": turns, "turn": n})
                    query = (said.get("user_query") or "").strip() if said.get("continue") else ""
                    if not query:
                        if n >= min_turns:
                            break
                        query = fallback_question(said.get("intent") or "", n)
                out.append((str(i), json.dumps(turns, ensure_ascii=False), compressed))
            yield pd.DataFrame(out, columns=["id", "turns", "compressed"])

    ship(rows.sparkSession)
    return rows.select("id", "user_query").mapInPandas(run, "id string, turns string, compressed string")


# What a user asks next when the simulator has nothing to say, by intent and turn.
_FIRST = {
    "技能培训": "能不能给我一个具体的课堂练习案例，让学生可以直接照着做？", "学情分析": "如果我要根据这个分析结果给学生安排补救训练，下一步该怎么做？", "教学方案设计": "能不能把这个教学流程再细化成一节课可以直接使用的安排？",
}
_FIRST_OTHER = "能不能再给一个更具体、可直接执行的示例？"
_SECOND, _LATER = "如果换一个类似但不完全相同的场景，应该怎么调整这个方案？", "还有哪些容易出错的地方需要提前提醒学生？"


def fallback_question(intent: str, turn: int) -> str:
    if turn == 1:
        return next((q for k, q in _FIRST.items() if k in intent), _FIRST_OTHER)
    return _SECOND if turn == 2 else _LATER
