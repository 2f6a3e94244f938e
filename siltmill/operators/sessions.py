"""Multi-turn sessions: turns from messages, recent and compressed history, compression points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.functions.text import history_context, render_dialogue


def turns_of(messages: DataFrame, session: str, turn: str, role: str, text: str) -> DataFrame:
    """``(session, turns array<struct<user,assistant>>)``: each user message with the assistant message that follows it.

    A session is one conversation, so its messages fit in a row; sessions themselves are spread.
    """
    w = Window.partitionBy(session).orderBy(turn)
    nxt = F.lead(F.struct(F.col(role).alias("r"), F.col(text).alias("t"))).over(w)
    paired = messages.withColumn("__n", nxt).where(F.col(role) == "user")
    one = F.struct(F.col(turn).alias("o"), F.col(text).alias("user"), F.when(F.col("__n.r") == "assistant", F.col("__n.t")).alias("assistant"))
    listed = paired.groupBy(session).agg(F.sort_array(F.collect_list(one)).alias("l"))
    return listed.select(session, F.transform("l", lambda x: F.struct(x["user"].alias("user"), x["assistant"].alias("assistant"))).alias("turns"))


def split_history(turns: Column, recent: int = 3) -> tuple[Column, Column]:
    """(older turns, last ``recent`` turns); with ``recent`` of 0 or less all are recent."""
    short = (F.size(turns) <= recent) | F.lit(recent <= 0)
    older = F.when(short, F.slice(turns, 1, 0)).otherwise(F.slice(turns, F.lit(1), F.size(turns) - recent))
    return older, F.when(short, turns).otherwise(F.slice(turns, F.greatest(F.size(turns) - recent, F.lit(0)) + 1, F.lit(max(recent, 1))))


def context(turns: Column, recent: int = 3) -> Column:
    older, last = split_history(turns, recent)
    return history_context(render_dialogue(older), render_dialogue(last))


def compression_points(turns: Column, recent: int = 3, every: int = 2) -> Column:
    """Turn numbers, from 1, at which the history is compressed: later than ``recent``, and ``every`` turns or
    more after the last time. A fold over the turns, as each point depends on the one before."""
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<int>").alias("at"))

    def step(state: Column, i: Column) -> Column:
        now = (i > recent) & (i - state["last"] >= every)
        return F.struct(F.when(now, i).otherwise(state["last"]).alias("last"), F.when(now, F.concat(state["at"], F.array(i))).otherwise(state["at"]).alias("at"))

    numbers = F.when(F.size(turns) > 0, F.sequence(F.lit(1), F.size(turns))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(numbers, start, step, lambda s: s["at"])


def recent_by_window(messages: DataFrame, session: str, turn: str, recent: int = 3) -> DataFrame:
    """``messages`` with ``is_recent``: whether it is among the session's last ``recent``."""
    nth = F.row_number().over(Window.partitionBy(session).orderBy(F.col(turn).desc()))
    return messages.withColumn("is_recent", (nth <= recent) | F.lit(recent <= 0))
