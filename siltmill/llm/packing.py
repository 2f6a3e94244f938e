"""Best-fit packing of token sequences into fixed-length bins.

Only lengths decide where a piece goes, and there are at most ``capacity`` of them. The packing is
therefore computed on the histogram of lengths, whatever the number of documents, and the result
is a small table of fills: "pieces number a to b of length n go into the bins from s on, at offset
o". Pieces are numbered within their length in salted cells, so that a length that a third of all
pieces share is numbered by many tasks.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltmill.llm.common import needed, text_batches
from siltmill.scratch import materialize

CAPACITY, END = 2048, 0
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Characters of which both tokenizer libraries say alike whether they are letters, digits or white space.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\u00a1-\u024f]")


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    The ids are those of the ``tokenizers`` file. The same vocabulary is also given as ranks, which
    ``tiktoken`` applies four times as fast. Merging by rank gives the ids that merging by the file's
    list gives, if under lower ranks each token splits into just the pair that its merge names; a
    test shows this of every token. Texts with other characters than Latin ones go through
    ``tokenizers`` itself, as the libraries' tables of letters may be of different age, and so do
    texts that hold the string of a special token, which gets its own id there.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.fast is None or _PLAIN.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None) -> Encoder:
    return Encoder(path, ranks)


@dataclass(frozen=True)
class Fill:
    """Pieces ``first`` to ``first + count - 1`` of ``length``: ``copies`` of them in each bin from ``bin`` on, from ``offset``."""

    length: int
    first: int
    count: int
    bin: int
    offset: int
    copies: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Fill], int]:
    """Fills for all pieces, and the number of bins.

    Pieces longer than a third of a bin pair at most twice per bin: the longest is matched with the
    longest that still fits beside it, which is a largest matching. Then the smaller ones, longest
    first, go where the gap left is smallest. Bins with equal gaps are handled as one range, so the
    work depends on the number of lengths and not on the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece must have 1 to capacity tokens")
    used: dict[int, int] = defaultdict(int)
    fills: list[Fill] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def put(n: int, count: int, at: int, offset: int, copies: int = 1) -> None:
        fills.append(Fill(n, used[n], count, at, offset, copies))
        used[n] += count
        left[n] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= n and m + n <= capacity and left[m] > (m == n)), None)
            if mate is None:
                gaps[capacity - n].append((bins, left[n]))
                start, bins = bins, bins + left[n]
                put(n, left[n], start, 0)
                continue
            pairs = left[n] // 2 if mate == n else min(left[n], left[mate])
            gaps[capacity - n - mate].append((bins, pairs))
            start, bins = bins, bins + pairs
            put(n, pairs, start, 0)
            put(mate, pairs, start, n)

    heap = sorted(gaps)  # gaps are looked up by size; sizes come and go
    sizes = set(heap)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        fit = sorted(g for g in sizes if g >= n)
        heapq.heapify(fit)
        while left[n] and fit:
            g = heapq.heappop(fit)
            if not gaps[g]:
                sizes.discard(g)
                continue
            start, count = gaps[g].pop()
            if gaps[g]:
                heapq.heappush(fit, g)
            else:
                sizes.discard(g)
            each = g // n  # best fit keeps filling the bin it has begun
            full = min(count, left[n] // each)
            rest = min(left[n] - full * each, each - 1) if full < count else 0
            offset = capacity - g
            for many, copies, begin in ((full, each, start), (1 if rest else 0, rest, start + full)):
                if many:
                    put(n, many * copies, begin, offset, copies)
                    gaps[g - copies * n].append((begin, many))
                    sizes.add(g - copies * n)
            untouched = count - full - (1 if rest else 0)
            if untouched:
                gaps[g].append((start + count - untouched, untouched))
                sizes.add(g)
        each = capacity // n
        for copies in (each, left[n] % each):
            many = left[n] // copies if copies else 0
            if many:
                gaps[capacity - copies * n].append((bins, many))
                sizes.add(capacity - copies * n)
                start, bins = bins, bins + many
                put(n, many * copies, start, 0, copies)
    return fills, bins


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, doc="doc_id", text="text") -> DataFrame:
    """``(doc, piece, start, length, ids_crc32)``: each text's ids and a closing 0, cut only if longer than a bin.

    All pieces of a long text but the first have ``capacity`` tokens. Null texts count as empty.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = None if vocabulary else public_tokenizers.path(RANKS)
    rows = text_batches(needed(docs, doc, text))
    kind = rows.schema[doc].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path, ranks)
        for b in batches:
            out = []
            for d, t in zip(b["doc"], b["t"], strict=True):
                ids = encoder.encode(t or "") + end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    size = (n - at - 1) % capacity + 1 if at == 0 else capacity
                    out.append((d, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at, k = at + size, k + 1
            yield pd.DataFrame(out, columns=["doc", "piece", "start", "length", "ids_crc32"])

    return rows.toDF("doc", "t").mapInPandas(cut, f"doc {kind}, piece int, start long, length long, ids_crc32 long")


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (any rows with a ``length`` of 1 to ``capacity``) with sequence_id and offset."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    fills, _ = plan(histogram, capacity)
    total, tasks = sum(histogram.values()), int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = max(1, total // (4 * tasks))  # rows that one salted cell of a length holds, about
    salts = spark.createDataFrame([(n, -(-c // cell)) for n, c in histogram.items()] or [(0, 1)], "length long, salts long")
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in cut.columns if c != "length")), F.col("salts"))
    dealt = cut.join(F.broadcast(salts), "length").withColumn("salt", salt).drop("salts")
    counts = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    others = [F.col(f"`{c}`") for c in cut.columns if c not in ("length", "ids_crc32")]
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*others)) - 1
    ranked = dealt.withColumn("own", own).join(counts, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    table = spark.createDataFrame([(f.length, f.first, f.first + f.count, f.bin, f.offset, f.copies) for f in fills] or [(0, 0, 0, 0, 0, 1)], "length long, first long, last long, bin long, begin long, copies long")
    # Ranks are whole numbers below last: each piece meets the one fill of its length that holds its rank.
    fits = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "last", "bin", "begin", "copies"))).alias("fills"))
    nth = F.col("rank")
    found = ranked.join(F.broadcast(fits), "length").withColumn("fill", F.element_at(F.filter("fills", lambda f: (f["first"] <= nth) & (nth < f["last"])), 1))
    within = F.col("rank") - F.col("fill.first")
    return found.select(
        *(F.col(f"`{c}`") for c in cut.columns),
        (F.col("fill.bin") + F.floor(within / F.col("fill.copies"))).cast("long").alias("sequence_id"),
        (F.col("fill.begin") + F.pmod(within, F.col("fill.copies")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, doc="doc_id", text="text") -> DataFrame:
    """``(doc, piece, start, length, ids_crc32, sequence_id, offset)``, a row for each piece.

    ``docs`` of any number of rows, repeated ones included, are packed whole; an empty table gives no
    row. Every sequence is gapless from 0 and has at most ``capacity`` tokens.
    """
    return place(materialize(pieces(docs, vocabulary, capacity, doc, text), "pieces"), capacity)
