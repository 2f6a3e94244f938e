"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from siltmill.ship import ship

#: Characters that separate words: the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows and bytes of an Arrow batch. Spark reads them when a plan runs, from the session, so they are the same for
#: all operators: a plan that is built later can't change the bound of one that is still to run.
TEXT_BATCH, BATCH_BYTES = 512, "16m"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_batches(df: DataFrame) -> DataFrame:
    """``df`` for a Python operator: the package is shipped, and what a worker holds at once is bounded by
    rows and by bytes, as texts may be very long."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def runs(texts: list, most: int) -> Iterator[slice]:
    """Slices of ``texts`` with ``most`` characters at most, or a single text that has more."""
    start = held = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > start and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` at its end; columns of the same name (in any case) give way."""
    taken = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *(c.alias(n) for n, c in columns.items()))


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, or longer ones where ``columns`` have such a name (in any case)."""
    taken, free = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        free.append(n)
    return free


def told_apart(df: DataFrame, *names: str) -> list[Column]:
    """What to hash so that unlike rows have unlike hashes. A hash passes over nulls, so that of ('a', null) is that of
    (null, 'a') and that of [1, null] that of [1]; a map or variant has none."""
    plain, added = [], []
    for n, field in zip(names, needed(df, *names).schema, strict=True):
        c, kind = F.col(f"`{n}`"), field.dataType
        added.append(c.isNull())
        if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            added.append(F.to_json(F.struct(c.alias("c"))))
        if "map<" not in kind.simpleString() and "variant" not in kind.simpleString():
            plain.append(c)
    return added + plain


def row_key(df: DataFrame, doc: str, text: str) -> list[Column]:
    """128 bits of a row's id and text, ``k1`` and ``k2``: equal ones have equal bits, a null being equal to nulls only."""
    both = told_apart(df, doc, text)
    return [F.xxhash64(*both).alias("k1"), F.xxhash64(F.lit(3), *both).alias("k2")]


def needed(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator works on, so that others never reach a shuffle or Python."""
    return df.select(*(F.col(f"`{n}`") for n in names))
