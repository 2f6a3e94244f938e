"""Cross-site boilerplate lines, by the spread of each line over distinct sites.

DataFrame operations only. A HyperLogLog sketch of sites per line hash merges by aggregation, so
a line that every document carries costs one small sketch per task, not a row per occurrence.
Only lines whose estimate is near the threshold are counted exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm.common import free_names, needed, replacing, row_key
from siltmill.scratch import materialize

#: What is trimmed from a line before it is compared.
BLANK = " \t\x0b\x0c\r"


@dataclass(frozen=True)
class Spread:
    """``min_sites`` distinct sites make a line boilerplate. ``near`` is the share of ``min_sites``
    on either side within which the sketch is not trusted; sketches of 2^12 registers err by 1.6 %
    and are exact for small counts. Up to ``broadcast_lines`` line hashes (16 bytes each) are sent
    to every executor; more are joined by shuffle."""

    min_sites: int = 10
    near: float = 0.2
    lg_k: int = 12
    broadcast_lines: int = 500_000


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _occurrences(docs: DataFrame, doc: str, text: str, site: str) -> DataFrame:
    """A row for each line that isn't blank: 128 bits of row key, position, 128 bits of line hash, site."""
    t, d = F.col(f"`{text}`"), F.col(f"`{doc}`")
    rows = needed(docs, *dict.fromkeys((doc, text, site))).where(t.isNotNull()).select(
        d.alias("doc"), F.col(f"`{site}`").cast("string").alias("site"), *row_key(docs, doc, text), F.posexplode(F.split(t, "\n")).alias("pos", "line")
    )
    key = _key(F.col("line"))
    return rows.where(key != "").select("doc", "k1", "k2", "pos", "site", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def line_spread(docs: DataFrame, spread: Spread = Spread(), doc="doc_id", text="text", site="source") -> tuple[DataFrame, DataFrame]:
    """(lines, occurrences): the boilerplate lines ``(h1, h2, sites, first_doc, first_pos)``, and every
    occurrence of a line that came near the threshold. Null sites count as no site."""
    low, high = spread.min_sites * (1 - spread.near), spread.min_sites * (1 + spread.near)
    all_lines = _occurrences(docs, doc, text, site)
    est = F.hll_sketch_estimate("sketch")
    sketched = (
        all_lines.where("site is not null")
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.hll_sketch_agg("site", spread.lg_k).alias("sketch"))
        .where((F.col("n") >= spread.min_sites) & (est >= low))
        .select("h1", "h2", est.alias("est"))
    )
    sketched = materialize(sketched, "lines")
    few = sketched.count() <= spread.broadcast_lines
    small = F.broadcast if few else (lambda x: x)
    seen = materialize(all_lines.join(small(sketched), ["h1", "h2"]), "occurrences")
    near = seen.where(F.col("est") <= high).where("site is not null").select("h1", "h2", "site").distinct()
    exact = near.groupBy("h1", "h2").agg(F.count("*").alias("exact"))
    first = seen.groupBy("h1", "h2").agg(F.max("est").alias("est"), F.min(F.struct("doc", "k1", "k2", "pos")).alias("first"))
    lines = (
        first.join(exact, ["h1", "h2"], "left")
        .select("h1", "h2", F.coalesce("exact", "est").alias("sites"), "first")
        .where(F.col("sites") >= spread.min_sites)
    )
    return materialize(lines, "boilerplate"), seen


def remove_boilerplate(docs: DataFrame, spread: Spread = Spread(), doc="doc_id", text="text", site="source", n_lines="n_lines", n_removed="n_removed") -> DataFrame:
    """``docs`` with ``text`` freed of boilerplate lines, and columns n_lines and n_removed, or of other names.

    A line, trimmed of white space, that stands in documents of ``min_sites`` distinct sites or
    more is removed from all places but the first, by document id and position, so that no text
    vanishes from the corpus. Blank lines stay. Null text stays null with 0 lines; an empty text
    is one blank line. Null sites count as no site; a null id sorts first. Rows with equal id and
    text are one document and are treated alike. Input columns named as the two counts (and
    nothing else) are replaced. Texts of any length are read whole; an empty table stays empty.
    """
    lines, seen = line_spread(docs, spread, doc, text, site)
    few = lines.count() <= spread.broadcast_lines
    flagged = lines.select("h1", "h2", "first")
    hit = seen.join(F.broadcast(flagged) if few else flagged, ["h1", "h2"])
    spare = F.struct("doc", "k1", "k2", "pos").eqNullSafe(F.col("first"))
    *key, drop = free_names([*docs.columns, n_lines, n_removed], "__k1", "__k2", "__drop")
    drops = hit.where(~spare).groupBy("k1", "k2").agg(F.collect_set("pos")).toDF(*key, drop)
    drops = materialize(drops, "drops")
    t = F.col(f"`{text}`")
    joined = docs.withColumns(dict(zip(key, row_key(docs, doc, text), strict=True))).join(drops, key, "left").drop(*key)
    split = F.split(t, "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(drop)), lambda i: F.get(split, i))
    counts = {
        n_lines: F.coalesce(F.when(t.isNotNull(), F.size(split)), F.lit(0)).cast("long"),
        n_removed: F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long"),
    }
    out = replacing(joined, **counts)
    clean = F.when(F.col(drop).isNull(), t).otherwise(F.array_join(kept, "\n"))
    order = [c for c in out.columns if c != drop]
    return out.withColumn(text, clean).select(*(F.col(f"`{c}`") for c in order))
