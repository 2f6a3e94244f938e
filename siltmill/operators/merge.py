"""Unions of row sets: by content signature, by id, with limits and a fixed metadata schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.jsonx import parsed, signature_of
from siltmill.functions.text import once, or_default
from siltmill.scratch import materialize

# The scalar metadata of a merged row with its defaults, in order.
METADATA = {
    "merge_source": "", "source": "", "source_id": "", "step": 0, "action": "", "include_reasoning": False, "planner_overridden": False,
    "tool_names": "", "has_tool_error": False, "has_file_write_plan": False, "file_written": False, "include_tool_errors": False,
    "answer_template_intent": "", "max_external_chars": 0, "planner_tool_sampling_mode": "", "intent": "", "has_clarification_ask": False,
    "domain": "", "executor_assembly_system_prompt_source": "",
}


def tagged(sources: list[DataFrame]) -> DataFrame:
    """All rows, with ``src`` as the number of the input; inputs are taken in this order."""
    return reduce(DataFrame.unionByName, (d.withColumn("src", F.lit(i)) for i, d in enumerate(sources)))


def first_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row of each key, the first by ``order``. A map-side combined minimum finds it, so a key that
    very many rows share is never sorted in one task; ``order`` must tell rows of a key apart."""
    at = F.struct(*order)
    first = rows.groupBy(key).agg(F.min(at).alias("__first"))
    return rows.join(first, key).where(at == F.col("__first")).drop("__first")


def merge_tasks(sources: list[DataFrame], raw: str = "raw", order: str = "row_idx", dedup_by: str = "auto", max_rows: int | None = None, existing: DataFrame | None = None) -> DataFrame:
    """N inputs of JSON lines with ``(order, raw)`` -> ``(src, order, raw, valid, signature, written)`` of the rows read.

    dedup_by auto compares bodies, id compares ids, none keeps all; signatures that ``existing(raw)`` has
    count as written before. Lines that aren't JSON, and null, are never written. With ``max_rows``, ``order``
    must number an input's rows from 0, and an input is read up to the first row written that is its
    ``max_rows``-th or later; what isn't read takes no signature.
    """
    if dedup_by not in ("auto", "id", "none"):
        raise ValueError(f"unknown dedup_by {dedup_by}")
    # Written, so that each line is parsed once and what marks it reads the signatures alone.
    rows = materialize(_signed(tagged([s.select(order, raw) for s in sources]), raw, dedup_by, F.concat_ws(":", "src", order)), "signed")
    seen = None
    if existing is not None and dedup_by != "none":
        seen = _signed(existing.select(raw), raw, dedup_by).where("valid").select("signature").distinct()
    if max_rows is None:
        return _marked(rows, order, seen)
    parts = []
    for src in range(len(sources)):
        part = materialize(_marked(rows.where(F.col("src") == src), order, seen), "source")
        last = part.where(F.col("written") & (F.col(order) >= max_rows - 1)).agg(F.min(order)).first()[0]
        part = part.where(F.col(order) <= last) if last is not None else part
        parts.append(part)
        if dedup_by != "none":
            own = part.where("written").select("signature")
            seen = materialize(own if seen is None else seen.unionByName(own), "seen")
    return reduce(DataFrame.unionByName, parts)


def _signed(rows: DataFrame, raw: str, dedup_by: str, alone: Column | None = None) -> DataFrame:
    sig = lambda v: signature_of(v, F.col(raw), dedup_by) if dedup_by != "none" else alone
    # A line is parsed once; without a signature it isn't valid.
    rows = rows.withColumn("signature", once(parsed(F.col(raw)), lambda v: F.when(v.isNotNull() & ~F.is_variant_null(v), sig(v))))
    return rows.withColumn("valid", F.col("signature").isNotNull())


def _marked(rows: DataFrame, order: str, seen: DataFrame | None) -> DataFrame:
    good = rows.where("valid")
    first = good.groupBy("signature").agg(F.min(F.struct("src", order)).alias("first"))
    if seen is not None:
        first = first.join(seen, "signature", "left_anti")
    kept = good.join(first, "signature", "left").withColumn("written", F.coalesce(F.struct("src", order) == F.col("first"), F.lit(False))).drop("first")
    return kept.unionByName(rows.where("not valid").withColumn("written", F.lit(False)), allowMissingColumns=True)


def merge_report(merged: DataFrame) -> DataFrame:
    """read, written, duplicated and invalid by input."""
    return merged.groupBy("src").agg(
        F.count("*").alias("read"), F.count_if("written").alias("written"),
        F.count_if(F.col("valid") & ~F.col("written")).alias("duplicated"), F.count_if(~F.col("valid")).alias("invalid"),
    )


def resume(rows: DataFrame, done: DataFrame, key: str = "id", limit: int | None = None, order: str | None = None) -> DataFrame:
    """Rows whose id isn't written yet; then the first ``limit`` by ``order``."""
    ids = done.select(F.col(key).cast("string").alias("__id")).where("__id <> ''").distinct()
    left = rows.join(ids, rows[key].cast("string") == ids["__id"], "left_anti")
    return left.orderBy(order).limit(limit) if limit is not None else left


def add_new(rows: DataFrame, done: DataFrame | None, order: str, limit: int | None = None, usable: Column | None = None) -> tuple[DataFrame, dict]:
    """What a sequential reader of ``rows(order, id, ...)`` adds, and its counts: rows whose id isn't ``done`` and that
    are ``usable``, the first of each id, up to ``limit``; reading stops once that many are added."""
    good = rows.where(usable) if usable is not None else rows
    fresh = first_wins(resume(good, done) if done is not None else good, "id", order)
    fresh = materialize(fresh.orderBy(order).limit(limit) if limit is not None else fresh, "added")
    count, last = fresh.agg(F.count("*"), F.max(order)).first()
    if limit is not None and count >= limit:
        rows = rows.where(F.col(order) <= last) if limit else rows.limit(0)
    return fresh, {"added": count, "skipped": rows.count() - count}


def as_text(raw: Column, name: str) -> Column:
    """Null as '', a list comma-joined, anything else as text."""
    value = F.get_json_object(raw, f"$.{name}")
    items = F.from_json(value, "array<string>")
    return F.coalesce(F.when(value.startswith("["), F.array_join(items, ",")), value, F.lit(""))


def as_int(raw: Column, name: str) -> Column:
    return F.coalesce(F.get_json_object(raw, f"$.{name}").try_cast("double").cast("long"), F.lit(0))


def as_truth(raw: Column, name: str) -> Column:
    """Python's truth: the text "false" is true, an empty text, list or object is not."""
    value = F.get_json_object(raw, f"$.{name}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), f"$.{name}", "variant"))
    return F.coalesce(F.when(kind == "STRING", value != "").otherwise(~value.isin("false", "0", "0.0", "[]", "{}")), F.lit(False))


def fixed_metadata(raw: Column, merge_source: str | None = None, fields: dict | None = None, extra: dict[str, Column] | None = None) -> Column:
    """Open metadata JSON as a struct of ``fields`` scalars, each cast by its default's type; ``extra`` columns go before
    what the metadata has under their names."""
    out = []
    for name, default in (fields or METADATA).items():
        if name == "merge_source" and merge_source is not None:
            value = F.lit(merge_source)
        elif extra and name in extra:
            value = extra[name] if isinstance(default, bool) else F.coalesce(extra[name].cast("string"), F.lit(""))
        elif isinstance(default, bool):
            value = as_truth(raw, name)
        elif isinstance(default, int):
            value = as_int(raw, name)
        else:
            value = or_default(as_text(raw, name), default)
        out.append(value.alias(name))
    return F.struct(*out)
