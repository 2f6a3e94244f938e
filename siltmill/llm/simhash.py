"""SimHash near-duplicates: a grid over segment popcounts proposes pairs, bits decide them.

A fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints, so fingerprints that differ in at most
two bits have vectors that differ in at most two places. The places are cut into groups; all groups
but two are then equal. Each distinct fingerprint is dealt to one cell for every choice of all groups but
two, six cells of four groups, and only fingerprints of one cell are compared.

A cell that holds few fingerprints has its pairs compared directly. The members of crowded cells
(thousands of near copies) are never expanded into pairs: they are split by the 64-bit strings one flip
away. Two fingerprints differ in at most two bits exactly if they share such a string, and at most
65 distinct fingerprints share one, so every group stays small and no link is lost.

Copies with more changes are found by the same bound on a longer fingerprint: see ``similar_links``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.llm.common import free_names, needed, row_key, text_batches, told_apart
from siltmill.operators.components import connected_components
from siltmill.operators.dedup import _verify as verify
from siltmill.scratch import discard, materialize
from siltmill.ship import ship

#: Words of a shingle, seed of its XXH64, bits that may differ.
SHINGLE, SEED, RADIUS = 3, 42, 2
#: Cells with more fingerprints than this are split by bit strings.
CROWDED = 16
#: Shingles whose bits are counted at a time, so that memory doesn't follow the length of a text.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 bits that are set in over half of the shingle hashes; 0 for a text without words."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= shingle:
        spans = iter([b" ".join(words)])
    else:
        spans = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        n = min(BLOCK, total - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s, _ in zip(spans, range(n), strict=False)), "<u8", n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc="doc_id", text="text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc, fp)``: a row for each row of ``docs``; fp holds the 64 bits as a signed long."""
    rows = text_batches(needed(docs, doc, text))
    kind = rows.schema[doc].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["t"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc": b["doc"], "fp": fp})

    return rows.toDF("doc", "t").mapInPandas(score, f"doc {kind}, fp long")


#: Segments of two bits: their lower bits.
_LOW = 0x5555555555555555
#: Groups that the segments are cut into, by the number of distinct fingerprints: six cells each of 24 bits
#: of random fingerprints' counts, or 28 cells of 36. The links are the same.
FEW_GROUPS, MANY_GROUPS, MANY = 4, 8, 1 << 26


def popcounts(fp: Column) -> Column:
    """Popcounts of the 32 segments, two bits each: 00, 01 or 10."""
    a, b = fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def cells(fp: Column, groups: int) -> Column:
    """A cell for each choice of all groups but ``RADIUS``: the counts of the segments in them."""
    at = popcounts(fp)
    ends = [64 * g // groups // 2 * 2 for g in range(groups + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]
    some = [sum(c) for c in combinations(masks, groups - RADIUS)]
    return F.array(*(F.xxhash64(F.lit(i), at.bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(some)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def links(prints: DataFrame, groups: int | None = None) -> DataFrame:
    """Distinct ``fp`` -> ``(src, dst)``: edges that connect exactly what chains of two-bit links connect."""
    groups = groups or (FEW_GROUPS if prints.count() <= MANY else MANY_GROUPS)
    dealt = prints.select("fp", F.explode(cells(F.col("fp"), groups)).alias("cell"))
    shared = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    shared = materialize(shared, "cells")
    twos = shared.where("n = 2").select(F.col("a").alias("src"), F.col("b").alias("dst")).where(_close(F.col("src"), F.col("dst")))
    members = materialize(dealt.join(shared.where("n > 2").select("cell", "n"), "cell"), "members")

    few = members.where(F.col("n") <= CROWDED).groupBy("cell").agg(F.collect_list("fp").alias("m"))
    pair = lambda x: F.transform(F.filter("m", lambda y: (y > x) & _close(x, y)), lambda y: F.struct(x.alias("src"), y.alias("dst")))
    few = few.select(F.inline(F.flatten(F.transform("m", pair))))

    fp = F.col("fp")
    strings = F.array(fp, *(fp.bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)))
    many = members.where(F.col("n") > CROWDED).select("fp").distinct().select("fp", F.explode(strings).alias("string"))
    many = many.groupBy("string").agg(F.collect_set("fp").alias("m"), F.min("fp").alias("src")).where(F.size("m") > 1)
    many = many.select("src", F.explode("m").alias("dst")).where("src <> dst")
    return twos.unionByName(few).unionByName(many)


def near_duplicates(docs: DataFrame, doc="doc_id", text="text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc, fp, component)``: a row for each row of ``docs``.

    Texts lose A-Z capitals and are cut at ASCII white space into words and shingles; with fewer
    words than a shingle the whole sequence is one, and null, empty or blank texts have fingerprint
    zero, which links like any other. ``component`` is the smallest id that chains of fingerprints
    differing in at most two bits reach (null ids are never the smallest). Repeated rows give
    repeated results; other columns are ignored.
    """
    prints = materialize(fingerprints(docs, doc, text, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc").alias("least")), "distinct")
    groups = connected_components(links(distinct.select("fp"))).withColumnsRenamed({"node": "fp", "component": "root"})
    linked = materialize(distinct.join(groups, "fp"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(least, "root").select("fp", "component")
    alone = distinct.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component"))
    return prints.join(named.unionByName(alone), "fp", "left").select("doc", "fp", "component")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """``docs`` with one row of each component of ``similar_documents``, that with the smallest id.

    Any column may be null; a row with an id goes before rows without one, and rows with one id go by
    a hash of their text. Of rows with equal ids and texts one stays, by a hash of all columns. Extra
    columns pass through, whatever their names; an empty table stays empty.
    """
    found = materialize(similar_documents(docs, doc, text), "components")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "k1", "k2")).alias("best")).select("root", "best.k1", "best.k2")
    best = materialize(best, "best")
    chosen = (F.col("r.k1") == F.col("b.k1")) & (F.col("r.k2") == F.col("b.k2"))
    *key, n = free_names(docs.columns, "__k1", "__k2", "__n")
    gone = found.alias("r").join(best.alias("b"), "root").where(~chosen).select("r.k1", "r.k2").distinct().toDF(*key)
    # No text is dealt out for the few that go: see _matched.
    kept = _matched(docs.withColumns(dict(zip(key, row_key(docs, doc, text), strict=True))), materialize(gone, "gone"), key, "left_anti")
    again = found.groupBy("k1", "k2").count().where("count > 1").drop("count").toDF(*key)
    again = materialize(again, "repeated")
    if not again.isEmpty():
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*told_apart(docs, *docs.columns))))
        one = _matched(kept, again, key, "left_semi").withColumn(n, nth).where(F.col(n) == 1).drop(n)
        kept = _matched(kept, again, key, "left_anti").unionByName(one)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


# Copies with more changes: five-word shingles, similarity 0.8 or more.

#: Words of the shingles that are compared, and their similarity.
WIDE_SHINGLE, SIMILAR = 5, 0.8
#: One in SHARE documents, SAMPLE at least, has its shingles counted to put a set's rare ones first; every executor
#: gets COMMON counts. They decide how many pairs meet, never which are found: any order that all sets share gives
#: the same links. A share, and not a number, keeps the cells of unsampled shingles alike at every size.
SHARE, SAMPLE, COMMON = 10, 1000, 400_000
#: Nodes of a cell that are compared at once; those of larger cells meet the least of their cell first. Cells that are
#: open then are compared within arrays up to OPEN nodes, and in blocks of about BLOCK_NODES beyond.
FEW, OPEN, BLOCK_NODES = 8, 64, 1000
#: Nodes of a cell, about, in which proposed pairs are verified.
HELD = 250
#: Segment counts that are subtracted at a time.
COMPARED = 1 << 22
#: Rows that are sent to every executor at most; more are joined by shuffle.
BROADCAST = 1_000_000
#: Bits that are sent instead for each of more keys; bits of a row of them; most rows (64 MB), beyond which more rows pass.
KEY_BITS, MAP_BITS, MOST_MAPS = 16, 1 << 18, 1 << 11
#: A set's prefix has a key more for every EXTRA of its shingles, and similar sets share so many more.
EXTRA = 50
#: Most segments are 2 to this power. Words whose hashes a Python worker remembers.
MOST_SEGMENTS, REMEMBERED = 20, 200_000


class _Hashes(dict):
    """Hashes of words; a bounded number of short ones is remembered."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, SEED)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


_HASHES = _Hashes()


def shingle_hashes(text: str | None, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles; of the whole text if it is shorter; none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(each))
    n = len(each) - size + 1
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ each[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed).view(np.int64)


def set_print(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of shingles as two signed longs: equal sets have equal ones, others don't."""
    if not len(hashes):
        return 0, 0
    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes(), SEED), ">i8")
    return int(hi), int(lo)


def segment_counts(hashes: np.ndarray) -> bytes:
    """A set as a bit vector over all hashes has one to two of its bits in each of these segments, on average;
    a byte holds a segment's popcount. Segments are equal ranges of hashes, so that two neighbours make
    one of the next wider kind."""
    bits = min(MOST_SEGMENTS, max(3, (len(hashes) - 1).bit_length() - 1))
    at = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def manhattan(a: bytes, b: bytes) -> int:
    """Distance of two vectors of segment popcounts: never more than the number of shingles that only one set has."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int16), np.frombuffer(b, np.uint8).astype(np.int16)
    while len(x) > len(y):
        x = x[::2] + x[1::2]
    while len(y) > len(x):
        y = y[::2] + y[1::2]
    return int(np.abs(x - y).sum())


def more_keys(size: int) -> int:
    """Keys that a set's prefix is longer than it must be for similar sets to share one; a number below 256."""
    return min(255, size // EXTRA)


def _prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(similarity n) + 1 + more_keys(n) of n shingles, rare ones first: two sets of that
    similarity share one, and as many more as the set has that has fewer."""
    if not len(hashes):
        return hashes
    seen = np.zeros(len(hashes), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        seen = np.where(common[at] == hashes, counts[at], 0)
    # Rounding may only lengthen a prefix, never shorten it.
    keep = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1 + more_keys(len(hashes))
    return hashes[np.lexsort((hashes, seen))[:keep]]


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of shingles that a sample of ``rows(doc, t)`` has in two texts or more."""
    step = min(SHARE, max(1, rows.count() // SAMPLE))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a stated number, as few bytes are much work here
    sample = rows.where(F.pmod(F.xxhash64("doc"), F.lit(step)) == 0).select("t").repartition(tasks, "t").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            key, n = np.unique(np.concatenate([np.zeros(0, np.int64), *map(shingle_hashes, b["t"])]), return_counts=True)
            yield pd.DataFrame({"key": key, "n": n})

    found = text_batches(sample).mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    found = found.orderBy(F.desc("n"), "key").limit(COMMON).toPandas().sort_values("key")
    return found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def set_prints(docs: DataFrame, doc="doc_id", text="text", similarity: float = SIMILAR) -> DataFrame:
    """``(doc, k1, k2, hi, lo, size, prefix, segments)``, a row for each row of ``docs``: 128 bits of the row,
    and the print, size, prefix and segment popcounts of its shingle set."""
    rows = needed(docs, *dict.fromkeys((doc, text))).select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("t"))
    common, counts = common_shingles(rows)
    rows = text_batches(rows.select("doc", *row_key(rows, "doc", "t"), "t"))
    kind = rows.schema["doc"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_hashes(t) for t in b["t"]]
            prints = np.array([set_print(s) for s in sets], np.int64).reshape(len(b), 2)
            out = {"doc": b["doc"], "k1": b["k1"], "k2": b["k2"], "hi": prints[:, 0], "lo": prints[:, 1], "size": [len(s) for s in sets]}
            yield pd.DataFrame(out | {"prefix": [_prefix(s, common, counts, similarity) for s in sets], "segments": [segment_counts(s) for s in sets]})

    return rows.mapInPandas(score, f"doc {kind}, k1 long, k2 long, hi long, lo long, size long, prefix array<bigint>, segments binary")


def _of_ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The ``nodes`` at the ends of ``edges(src, dst)``, as a table of their own."""
    ends = materialize(edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), "ends")
    return materialize(_matched(nodes, ends, ["node"], "left_semi"), "some")


def _small(rows: DataFrame) -> DataFrame:
    """A written table, to be sent to every executor if it has few rows; else it is joined by shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST else rows


def _matched(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Wide ``rows`` joined with a written table whose ``on`` is never null: inner, left_semi or left_anti.

    If it has few rows, it is sent to every executor. Else a bit map of its keys is: rows that it rules out have no match,
    exactly, and stay where they are. Only the others, with one in KEY_BITS or so of all, are dealt out to meet the keys.
    """
    n = keys.count()
    if n <= BROADCAST:
        return rows.join(F.broadcast(keys), on, how)
    maps, held = _bit_maps(keys, on, n, free_names(rows.columns, "__map", "__bits"))
    maybe = rows.join(maps, held, "left_semi").join(keys, on, how)
    return rows.join(maps, held, "left_anti").unionByName(maybe) if how == "left_anti" else maybe


def _bit_maps(keys: DataFrame, on: list[str], n: int, names: list[str] | tuple[str, ...] = ("__map", "__bits")) -> tuple[DataFrame, Column]:
    """A bit map of ``n`` keys, cut into rows of two columns of these names, to be sent to every executor; the condition that it may hold a key."""
    hashed, count = F.xxhash64(F.lit(5), *on), min(MOST_MAPS, -(-KEY_BITS * n // MAP_BITS))
    number, at = F.pmod(hashed, F.lit(count)).cast("long"), F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(MAP_BITS - 1)).cast("int")

    def build(held: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(MAP_BITS, np.uint8)
        bits[held["at"]] = 1
        return pd.DataFrame({"map": held["map"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").view("<i8")]})

    ship(keys.sparkSession)
    maps = keys.select(number.alias("map"), at.alias("at")).groupBy("map").applyInPandas(build, "map long, bits array<bigint>").toDF(*names)
    word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63))
    return F.broadcast(materialize(maps, "bits")), (number == F.col(names[0])) & (F.getbit(F.get(names[1], word), bit) == 1)


def _within(edges: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The ``edges(src, dst)`` that the Manhattan distance of the ends' segment popcounts doesn't rule out."""
    ship(edges.sparkSession)
    share = (1 - similarity) / (1 + similarity)

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([manhattan(x, y) <= m for x, y, m in zip(a, b, most, strict=True)], dtype=bool)

    some = _of_ends(nodes.select("node", "size", "segments"), edges)
    src = some.select(F.col("node").alias("src"), F.col("size").alias("m"), F.col("segments").alias("a"))
    dst = some.select(F.col("node").alias("dst"), F.col("size").alias("n"), F.col("segments").alias("b"))
    most = (F.col("m") + F.col("n")) * F.lit(share) + F.lit(1e-6)
    return edges.join(src, "src").join(dst, "dst").where(near("a", "b", most)).select("src", "dst")


def _cells_of(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` with ``c, i, j``: the cell where an edge is verified.

    What edges connect is dealt to one cell, so that a text is sent once, however many edges it has; small components share
    cells of about HELD nodes. A component of more is cut into blocks, each pair of which is a cell.
    """
    groups = connected_components(edges)
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / HELD).alias("blocks"))
    named = groups.join(sizes, "component")
    several, shared = F.col("blocks") > 1, groups.count() // HELD + 1
    cell = F.when(several, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(shared)))
    named = materialize(named.select("node", cell.alias("c"), F.pmod(F.xxhash64("node"), "blocks").alias("block")), "dealt")
    ends = edges.join(_small(named.select(F.col("node").alias("src"), "c", F.col("block").alias("x"))), "src")
    ends = ends.join(_small(named.select(F.col("node").alias("dst"), F.col("block").alias("y"))), "dst")
    return ends.select("src", "dst", "c", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"))


def _verified(edges: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the ``edges(src, dst)`` between ``nodes(node, k1, k2, size, segments)`` that have the similarity, as many as connect
    what all of a cell connect; their sets are made again from ``texts(k1, k2, t)``, where they meet."""
    edges = materialize(_within(materialize(edges, "proposed"), nodes, similarity), "within")
    cells = materialize(_cells_of(edges), "where")
    wanted = _of_ends(nodes.select("node", "k1", "k2"), edges)
    held = _matched(texts, wanted, ["k1", "k2"], "inner").groupBy("node").agg(F.min("t").alias("t"))
    asked = materialize(cells.select(F.col("c").alias("p"), F.col("i").alias("q"), F.col("j").alias("r"), F.explode(F.array("src", "dst")).alias("node")).distinct(), "asked")
    held = held.join(_small(asked), "node")

    def compare(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sets = pd.DataFrame({"node": held["node"], "grams": [shingle_hashes(t) for t in held["t"]]})
        found = verify(pairs.rename(columns={"src": "left", "dst": "right"}), sets, similarity, True)
        return pd.DataFrame({"src": found["left"], "dst": found["right"]})

    ship(edges.sparkSession)
    found = cells.groupBy("c", "i", "j").cogroup(held.groupBy("p", "q", "r")).applyInPandas(compare, "src long, dst long")
    found = materialize(found, "similar")
    discard(cells, asked, wanted, edges)
    return found


def _near(a_size, a_at, b_size, b_at, similarity: float):
    """Whether a shared shingle at these places of two prefixes leaves room for the similarity: what precedes it, it, and
    what follows."""
    need = (a_size + b_size) * F.lit(similarity / (1 + similarity)) - F.lit(1e-6)
    return F.least(a_at, b_at) + F.least(a_size - a_at, b_size - b_at) >= need


def _within_cells(rows: DataFrame, apart: bool, similarity: float) -> DataFrame:
    """``rows(key, node, size, at[, group])`` of small cells -> ``(src, dst)``, a row for each pair and cell."""
    held = ["node", "size", "at", "group"] if apart else ["node", "size", "at"]
    cells = rows.groupBy("key").agg(F.collect_list(F.struct(*held)).alias("m"))

    def others(x: Column) -> Column:
        fits = lambda y: (y["node"] < x["node"]) & _near(x["size"], x["at"], y["size"], y["at"], similarity) & ((y["group"] != x["group"]) if apart else F.lit(True))
        return F.transform(F.filter("m", fits), lambda y: F.struct(x["node"].alias("src"), y["node"].alias("dst")))

    return cells.select(F.inline(F.flatten(F.transform("m", others))))


def _compare(cell: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Pairs of a block of a large cell that the Manhattan distance leaves, if they haven't met in an earlier cell."""
    i, j = int(cell["i"].iloc[0]), int(cell["j"].iloc[0])
    node, group, size, at, own = (cell[c].to_numpy() for c in ("node", "group", "size", "at", "block"))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    met = _earlier(cell["cells"], cell["ats"], at)
    n, m, p, q = size[left][:, None], size[right][None], at[left][:, None], at[right][None]
    open_ = (group[left][:, None] != group[right][None]) & (met[left] @ met[right].T == 0)
    open_ &= np.minimum(p, q) + np.minimum(n - p, m - q) >= (n + m) * (similarity / (1 + similarity)) - 1e-6
    if i == j:
        open_ &= node[left][:, None] > node[right][None]
    x, y = np.nonzero(open_)
    x, y = left[x], right[y]
    counts = [np.frombuffer(c, np.uint8).astype(np.int16) for c in cell["segments"]]
    wide = np.array([len(c) for c in counts], np.int64)
    narrow, near = np.minimum(wide[x], wide[y]), np.zeros(len(x), bool)
    for width in np.unique(narrow):  # the narrower of two vectors decides; the wider is folded to it
        pairs = np.flatnonzero(narrow == width)
        used = np.unique(np.concatenate([x[pairs], y[pairs]]))
        place = np.zeros(len(cell), np.int64)
        place[used] = np.arange(len(used))
        folded = np.stack([counts[k].reshape(width, -1).sum(axis=1, dtype=np.int16) for k in used])
        step = max(1, COMPARED // int(width))
        for some in (pairs[k : k + step] for k in range(0, len(pairs), step)):
            far = np.abs(folded[place[x[some]]] - folded[place[y[some]]]).sum(axis=1, dtype=np.int64)
            near[some] = far <= (size[x[some]] + size[y[some]]) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return pd.DataFrame({"src": node[x[near]].astype(np.int64), "dst": node[y[near]].astype(np.int64)})


def _earlier(cells: pd.Series, ats: pd.Series, at: np.ndarray) -> np.ndarray:
    """A row for each node, a column for each large cell that stands before this one in a node's prefix; 1 where it has it."""
    sizes = np.fromiter(map(len, cells), np.int64, len(cells))
    owner = np.repeat(np.arange(len(cells)), sizes)
    names, column = np.unique(np.concatenate([np.zeros(0, np.int64), *cells]), return_inverse=True)
    before = np.concatenate([np.zeros(0, np.int64), *ats]) < at[owner]
    met = np.zeros((len(cells), max(1, len(names))), np.float32)
    met[owner[before], column[before]] = 1
    return met[:, met.any(axis=0)] if before.any() else met[:, :1]


def _large_cells(rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``rows(key, node, size, at, group, n)`` of large cells -> ``(src, dst)``.

    Within a cell the nodes of its largest group never meet each other: the others, in blocks of about
    BLOCK_NODES, meet each other and that group's blocks. Each pair of blocks is a task's work, and a pair of nodes is compared
    in the first cell they share.
    """
    ship(rows.sparkSession)
    mine = rows.groupBy("node").agg(F.collect_list("at").alias("ats"), F.collect_list("key").alias("cells"))  # no more than a prefix has
    sizes = rows.groupBy("key", "group").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "group")).alias("top"), F.sum("c").alias("all"))
    blocks = lambda c: F.ceil(c / BLOCK_NODES).cast("long")
    sizes = sizes.select("key", F.col("top.group").alias("top"), blocks(F.col("all") - F.col("top.c")).alias("others"), blocks(F.col("top.c")).alias("tops"))
    dealt = rows.join(sizes, "key").join(mine, "node").join(nodes.select("node", "segments"), "node")
    is_top, draw = F.col("group") == F.col("top"), F.pmod(F.xxhash64("node"), F.when(F.col("group") == F.col("top"), F.col("tops")).otherwise(F.col("others")))
    dealt = dealt.withColumn("block", F.when(is_top, F.col("others") + draw).otherwise(draw))  # the largest group's blocks come last
    met = F.when(is_top, F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("others") + F.col("tops") - 1))
    dealt = dealt.withColumn("other", F.explode(met))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "group", "size", "at", "segments", "ats", "cells")
    return dealt.groupBy("key", "i", "j").applyInPandas(lambda cell: _compare(cell, similarity), "src long, dst long")


def similar_links(nodes: DataFrame, texts: DataFrame, similarity: float = SIMILAR) -> DataFrame:
    """``nodes(node, k1, k2, size, prefix, segments)`` -> ``(src, dst)``: edges that connect exactly what chains of
    similar pairs connect. The last eight bits of ``node`` are ``more_keys(size)``.

    The fingerprint of a set is the set itself, as a bit vector over all hashes: sets of similarity s differ in
    at most (1 - s) / (1 + s) of their bits, so such a pair agrees on bits among the first of each, in an
    order that puts rare ones first. Those bits are the cells of the grid. Two that meet in a cell are
    compared by the Manhattan distance of their segment popcounts, a lower bound of the bits that differ, and
    what that leaves is verified on the sets.

    Pairs of small cells are counted first, as similar ones share several. In a larger cell each node
    meets one leader only, so that a large group of near copies is connected without its pairs. Then all
    nodes of a cell that aren't connected yet meet each other.
    """
    # Every node is dealt many times, so what is dealt is narrow: place and size share a long.
    dealt = nodes.select("node", "size", F.posexplode("prefix").alias("at", "key"))
    dealt = dealt.select("key", "node", F.shiftleft(F.col("size"), 32).bitwiseOR(F.col("at").cast("long")).alias("place"))
    shared = dealt.groupBy("key").agg(F.count("*").alias("n"), F.max("node").alias("src"), F.min("node").alias("dst")).where("n > 1")
    shared = materialize(shared, "cells")
    more = materialize(shared.where("n > 2").select("key", "n"), "larger")
    size, at = F.shiftright("place", 32), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    members = _matched(dealt, more, ["key"], "inner")
    members = materialize(members.select("key", "node", size.alias("size"), at.alias("at"), "n"), "members")
    small, large = members.where(F.col("n") <= FEW), members.where(F.col("n") > FEW)

    met = shared.where("n = 2").select("src", "dst").unionByName(_within_cells(small, False, similarity)).groupBy("src", "dst").agg(F.count("*").alias("k"))
    least = F.least(F.col("src").bitwiseAND(F.lit(255)), F.col("dst").bitwiseAND(F.lit(255))) + 1
    pairs = met.where(F.col("k") >= least).select("src", "dst")
    # The node that shares the most cells has the fewest changes of its own, so that most copies are similar to it.
    large = materialize(large.join(large.groupBy("node").agg(F.count("*").alias("held")), "node"), "large")
    leads = large.groupBy("key").agg(F.max(F.struct("held", "node", "size", "at")).alias("lead"))
    star = large.join(leads, "key").where((F.col("node") != F.col("lead.node")) & _near(F.col("size"), F.col("at"), F.col("lead.size"), F.col("lead.at"), similarity))
    pairs = pairs.unionByName(star.select(F.col("node").alias("src"), F.col("lead.node").alias("dst"))).distinct()
    first = _verified(pairs, nodes, texts, similarity)

    groups = connected_components(first)
    group = F.coalesce("component", "node")
    grouped = large.drop("held").join(groups, "node", "left").withColumn("group", group).drop("component")
    mixed = grouped.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("key")
    grouped = materialize(grouped.join(mixed, "key"), "open")
    pairs = _within_cells(grouped.where(F.col("n") <= OPEN), True, similarity).unionByName(_large_cells(grouped.where(F.col("n") > OPEN), nodes, similarity))
    second = _verified(pairs.distinct(), nodes, texts, similarity)
    discard(shared, more, members, large, grouped)
    return first.unionByName(second)


def similar_documents(docs: DataFrame, doc="doc_id", text="text", similarity: float = SIMILAR) -> DataFrame:
    """``(doc, k1, k2, hi, lo, root, component)``, a row for each row of ``docs``: ``component`` is the smallest id
    that chains of similar documents reach, and ``root`` numbers the component.

    Documents are similar if their five-word shingle sets are equal (null, empty and blank texts have the
    empty one) or have a Jaccard similarity of ``similarity`` or more; every such pair is found. Every
    row is a document, so rows with one id may lie in different components; ids may be of any type that
    has an order, and null ones are never the smallest: a component without any other has a null one.
    """
    spare_bits = F.least(F.lit(255), F.floor(F.col("size") / EXTRA)).cast("long")  # see more_keys
    prints = set_prints(docs, doc, text, similarity).withColumn("row", F.shiftleft(F.monotonically_increasing_id(), 8).bitwiseOR(spare_bits))
    prints = materialize(prints, "prints")  # numbered once, when it is written
    sets = prints.groupBy("hi", "lo").agg(F.min("row").alias("node"), F.min("doc").alias("least"))
    sets = materialize(sets, "nodes")
    spare = prints.select("row", "hi", "lo").join(sets, ["hi", "lo"]).where("row <> node").select("row")
    spare = materialize(spare, "spare")
    nodes = _matched(prints, spare, ["row"], "left_anti")
    nodes = nodes.withColumnRenamed("row", "node").select("node", "k1", "k2", "size", "prefix", "segments")
    texts = needed(docs, *dict.fromkeys((doc, text))).select(*row_key(docs, doc, text), F.col(f"`{text}`").alias("t"))
    groups = connected_components(similar_links(nodes, texts, similarity)).withColumnRenamed("component", "root")
    sets = sets.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sets = materialize(sets.select("hi", "lo", "root", "least"), "classes")
    named = sets.groupBy("root").agg(F.min("least").alias("component"))
    found = sets.select("hi", "lo", "root").join(named, "root")
    return prints.select("doc", "k1", "k2", "hi", "lo").join(found, ["hi", "lo"]).select("doc", "k1", "k2", "hi", "lo", "root", "component")
