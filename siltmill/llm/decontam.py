"""Benchmark decontamination with spaced seeds. DataFrame operations only.

Words are hashed once. Each position of a document gives one key per mask, computed from the
hashed words at the mask's places inside generated code, and meets the benchmark's keys there:
nothing of a document is sorted or shuffled until a key has met. Around each hit the words on either side
are then compared, and an overlap that is long enough, with few enough substitutions, is a leak.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm.common import free_names, needed, row_key
from siltmill.scratch import materialize


@dataclass(frozen=True)
class Seeds:
    """In a mask, 1 keeps a word and 0 ignores it. The first mask repeats every three words, so each single
    substitution falls on an ignored place of one of its three neighbouring positions.

    A hit is verified if ``overlap`` words in a row that hold all of its mask's words agree but for
    ``max_substitutions`` at most: any 13 words with at most one substitution are found, and with two if these
    fall on ignored places. Fewer words are enough where the document or the item has no more. Items shorter
    than the shortest mask have no substitutions; those of ``phrase`` words or more are found anywhere in a
    document, and shorter ones only as a whole document. Up to ``broadcast_keys`` benchmark keys go to every executor at
    once; a larger benchmark is taken in blocks of that many.
    """

    masks: tuple[str, ...] = ("11011011011", "1110100010111")
    overlap: int = 13
    max_substitutions: int = 2
    phrase: int = 5
    broadcast_keys: int = 3_000_000

    @property
    def shortest(self) -> int:
        return min(map(len, self.masks))

    @property
    def reach(self) -> int:
        """Words before a hit's place that its overlap may begin with."""
        return max(0, self.overlap - self.shortest)

    @property
    def window(self) -> int:
        """Words in which every overlap with a hit lies, from ``reach`` words before its place."""
        return self.reach + max(self.overlap, *map(len, self.masks))

    def keep(self, mask: int) -> list[int]:
        return [i for i, c in enumerate(self.masks[mask]) if c == "1"]


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _places(rows: DataFrame, hashes: str, pos: str, shortest: int) -> DataFrame:
    """``rows`` with ``pos``: a row for each place where ``shortest`` words follow.

    The outer form of explode keeps Spark from inferring a filter that would hash all words again.
    What follows, up to a join and the projection above it, stays in one generated loop, so
    ``hashes`` is referred to and not copied into each row. The loop is kept short enough to be
    compiled: a long one would be interpreted and an order of magnitude slower.
    """
    rows = rows.select("*", F.posexplode_outer(hashes).alias(pos, "__word")).drop("__word")
    return rows.where(F.col(pos) <= F.size(hashes) - shortest)


def _key(hashes: str, pos: str, seeds: Seeds, mask: int, shortest: int) -> Column:
    key = F.xxhash64(F.lit(mask), *(F.get(F.col(hashes), F.col(pos) + i) for i in seeds.keep(mask)))
    size = len(seeds.masks[mask])
    return key if size == shortest else F.when(F.col(pos) <= F.size(hashes) - size, key)


def _whole_key(hashes: str, pos: str, seeds: Seeds, length: int) -> Column:
    """Key of ``length`` words in a row; if they are fewer than ``phrase``, only of a text that has no others."""
    key = F.xxhash64(F.lit(-length), *(F.get(F.col(hashes), F.col(pos) + i) for i in range(length)))
    fits = F.col(pos) <= F.size(hashes) - length
    return F.when(fits if length >= seeds.phrase else fits & (F.size(hashes) == length), key)


def _hits(rows: DataFrame, items: DataFrame, seeds: Seeds) -> DataFrame:
    """``(doc, item, pos, ipos, reach, n, dw)`` of every key that a document ``(doc, h)`` and an item ``(item, ih)`` share:
    places, words that the key spans, the document's words and those from ``seeds.reach`` before the place on."""
    spans = [(F.lit(len(m)), lambda h, p, at, k=k: _key(h, p, seeds, k, at)) for k, m in enumerate(seeds.masks)]
    tests = _places(items.where(F.size("ih") >= seeds.shortest), "ih", "ipos", seeds.shortest)
    kinds = [F.struct(key("ih", "ipos", seeds.shortest).alias("key"), size.alias("reach")) for size, key in spans]
    tests = tests.select("item", "ipos", F.explode(F.array(*kinds)).alias("k")).select("item", "ipos", "k.*").where("key is not null")
    short = items.where(F.size("ih").between(1, seeds.shortest - 1))
    lengths = sorted(r["n"] for r in short.select(F.size("ih").alias("n")).distinct().collect())  # fewer than a mask has places
    for n in lengths:
        own = short.where(F.size("ih") == n).select("item", F.lit(0).alias("ipos"), "ih")
        tests = tests.unionByName(own.select("item", "ipos", _whole_key("ih", "ipos", seeds, n).alias("key"), F.lit(n).alias("reach")))
    tests = materialize(tests, "benchmark")
    blocks = max(1, -(-tests.count() // max(1, seeds.broadcast_keys)))
    shortest = min([seeds.shortest, *lengths])
    keys = [key("h", "pos", shortest) for _, key in spans] + [_whole_key("h", "pos", seeds, n) for n in lengths]
    dealt = _places(rows, "h", "pos", shortest).select("doc", "h", "pos", F.explode(F.array(*keys)).alias("key"))
    around = F.transform(F.sequence(F.lit(-seeds.reach), F.lit(seeds.window - seeds.reach - 1)), lambda k: F.when(F.col("pos") + k >= 0, F.get("h", F.col("pos") + k)))
    found = None
    for b in range(blocks):
        some = tests.where(F.pmod("key", F.lit(blocks)) == b) if blocks > 1 else tests
        met = dealt.join(F.broadcast(some), "key").select("doc", "item", "pos", "ipos", "reach", F.size("h").alias("n"), around.alias("dw"))
        found = met if found is None else found.unionByName(met)
    return found


def _verified(hits: DataFrame, items: DataFrame, seeds: Seeds) -> DataFrame:
    """The hits in an overlap: 0 marks an equal pair of words, 1 a substitution, and a place outside of either text rules out."""
    iw = lambda k: F.when(F.col("ipos") + k >= 0, F.get("ih", F.col("ipos") + k))
    pair = lambda w, k: F.coalesce(F.when(w == iw(k - seeds.reach), 0).when(w != iw(k - seeds.reach), 1), F.lit(1000))
    joined = hits.join(items, "item").withColumn("z", F.transform("dw", pair))
    need = F.least(F.lit(seeds.overlap), F.col("n"), F.size("ih"))

    def agrees(start: Column) -> Column:
        holds = start - seeds.reach + need >= F.col("reach")
        return holds & (F.aggregate(F.slice("z", start + 1, need), F.lit(0), lambda a, x: a + x) <= seeds.max_substitutions)

    long = F.col("reach") >= F.lit(seeds.shortest)
    return joined.where(~long | F.exists(F.sequence(F.lit(0), F.lit(seeds.reach)), agrees))


def contaminated(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds(), doc="doc_id", text="text", item="item_id", item_text="text") -> DataFrame:
    """``(doc_id, item_id, n_hits, first_word, last_word)``, a row for each document and benchmark item
    that overlap: they agree on all words that a mask keeps, and the hit's surroundings are verified.

    n_hits counts verified (place in the document, place in the item, mask) triples; first_word is the place of
    the first hit in the document, in words from 0, and last_word the last word that the last hit's
    mask reaches. Items with equal words are compared once and each reported. Texts that are null or have no
    words share nothing. Rows with equal ids count as one document, null ids too; very long texts are read whole.
    """
    named = needed(benchmark, *dict.fromkeys((item, item_text)))
    named = named.select(F.col(f"`{item}`").alias("id"), word_hashes(F.col(f"`{item_text}`")).alias("ih")).where(F.size("ih") > 0)
    named = materialize(named.withColumn("item", F.xxhash64(F.size("ih"), "ih")).select("id", "item", "ih"), "items")
    items = named.groupBy("item", "ih").agg(F.lit(1).alias("one")).drop("one")
    rows = needed(docs, *dict.fromkeys((doc, text))).select(F.col(f"`{doc}`").alias("doc"), word_hashes(F.col(f"`{text}`")).alias("h"))
    hits = materialize(_hits(rows, items, seeds), "hits")
    found = _verified(hits, items, seeds).groupBy("doc", "item").agg(
        F.count("*").alias("n_hits"), F.min("pos").cast("long").alias("first_word"), F.max(F.col("pos") + F.col("reach") - 1).cast("long").alias("last_word")
    )
    found = found.join(named.select("id", "item").distinct(), "item")
    return found.select(F.col("doc").alias(doc), F.col("id").alias(item), "n_hits", "first_word", "last_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds(), doc="doc_id", text="text", **columns) -> DataFrame:
    """``docs`` without the rows that ``contaminated`` finds; each row is judged by itself, with or without an id."""
    key = free_names(docs.columns, "__k1", "__k2")
    rows = docs.select(F.struct(*row_key(docs, doc, text)).alias("row"), F.col(f"`{text}`").alias("text"))
    found = contaminated(rows, benchmark, seeds, "row", "text", **columns).select("row").distinct()
    found = materialize(found.select("row.k1", "row.k2").toDF(*key), "leaks")
    kept = docs.withColumns(dict(zip(key, row_key(docs, doc, text), strict=True))).join(found, key, "left_anti")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
