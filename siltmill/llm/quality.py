"""Quality rules: base limits, then gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.llm import boosting
from siltmill.llm.common import needed, replacing, text_batches

WINDOW = 5
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: (feature, +1 if quality may only rise with it, -1 if it may only fall, 0 if free)
FEATURES = (
    ("log_words", 0), ("word_length", 0), ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1),
    ("distinct_share", 0), ("upper_share", -1), ("digit_share", 0), ("other_share", -1), ("words_per_line", 0),
    ("bar_share", -1), ("exclaim_share", -1), ("stop_share", 0), ("longest_word", -1),
)
MONOTONE = np.array([m for _, m in FEATURES])


@dataclass(frozen=True)
class Limits:
    """A document fails the base with fewer than ``min_words``, or more than ``max_repeat_percent`` of
    its words in repeated windows. The trees are fitted on at most ``max_labelled`` labelled documents
    (those with the smallest hash of their id) and reject below ``min_quality``."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_labelled: int = 20_000
    min_quality: float = 0.5


def _repeated(ids: np.ndarray, kinds: int) -> int:
    """Positions covered by windows that occur at least twice."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    m = n - WINDOW + 1
    key, size = ids[:m].copy(), kinds
    for j in range(1, WINDOW):
        if size > (1 << 62) // max(kinds, 1):  # the next product would not fit: rank what there is, which keeps equality
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key = key * kinds + ids[j : j + m]
        size *= kinds
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    if len(count) == m:
        return 0
    again = count[place] > 1
    covered = np.zeros(n, bool)
    for j in range(WINDOW):
        covered[j : j + m] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the features of one text; a null text has no word."""
    if not text:
        return (0,) * len(BASE), (0.0,) * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    n_space = len(raw) - len(raw.translate(None, SPACE))
    word_chars = len(text) - n_space
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    repeat = _repeated(ids, len(seen))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    per_char, per_word = 1 / max(word_chars, 1), 1 / max(n, 1)
    ascii_marks = len(raw) - len(raw.translate(None, b"!\"'()+,-./:;=?@[\\]^_`{}~"))
    stops = sum(w in _STOP for w in words)
    features = (
        float(np.log1p(n)), word_chars * per_word, symbols * per_word, dup_lines / max(len(lines), 1), repeat * per_word,
        len(seen) * per_word, upper * per_char, digits * per_char, ascii_marks * per_char, n / max(len(lines), 1),
        raw.count(b"|") * per_word, raw.count(b"!") * per_word, stops * per_word, float(min(max(map(len, words), default=0), 1000)),
    )
    return (n, word_chars, symbols, dup_lines, repeat), features


#: Frequent function words of English, French, German and Spanish.
_STOP = frozenset(
    w.encode() for w in "the of and to in a is that for it with as was on be at by this are from le la les de des du et en un une que qui dans pour pas sur au par plus der die das und ist von zu mit nicht den dem ein eine auf im el los las del y se con su para al".split()
)


def document_statistics(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """``(doc, base counts, f array<double>)``, a row for each row of ``docs``."""
    rows = text_batches(needed(docs, doc, text))
    kind = rows.schema[doc].dataType.simpleString()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [statistics(t) for t in b["t"]]
            out = pd.DataFrame([x[0] for x in found], columns=list(BASE), dtype=np.int64)
            out.insert(0, "doc", b["doc"].to_numpy())
            out["f"] = [x[1] for x in found]
            yield out

    return rows.toDF("doc", "t").mapInPandas(measure, f"doc {kind}, {', '.join(f'{c} long' for c in BASE)}, f array<double>")


def train(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), doc="doc_id", text="text", label="quality") -> boosting.Forest:
    """Trees fitted on a bounded sample of labelled documents; without labels of both kinds, a constant.

    A document labelled twice counts once, with its lowest label. Null labels and ids are no label.
    """
    named = labels.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{label}`").cast("int").alias("y")).where("doc is not null and y is not null")
    sample = named.groupBy("doc").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc"), "doc").limit(limits.max_labelled)
    texts = needed(docs, doc, text).join(F.broadcast(sample.select(F.col("doc").alias(doc))), doc, "left_semi")
    rows = document_statistics(texts, doc, text).groupBy("doc").agg(F.min("f").alias("f")).join(sample, "doc")
    found = rows.select("doc", "f", "y").toPandas().sort_values("doc")  # at most max_labelled rows
    if found.empty:
        return boosting.constant(1.0)
    return boosting.fit(np.array(found["f"].tolist()), (found["y"].to_numpy() > 0).astype(float), MONOTONE)


def judge(docs: DataFrame, model: boosting.Forest, limits: Limits = Limits(), doc="doc_id", text="text") -> DataFrame:
    """``(doc, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept)``.

    One row per input row; null and empty texts have no words and fail the base. Nothing is shuffled.
    """
    rows = text_batches(needed(docs, doc, text))
    kind = rows.schema[doc].dataType.simpleString()

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [statistics(t) for t in b["t"]]
            out = pd.DataFrame([x[0] for x in found], columns=list(BASE), dtype=np.int64)
            out.insert(0, "doc", b["doc"].to_numpy())
            failed = (out["n_words"] < limits.min_words) | (100 * out["n_repeat_words"] > limits.max_repeat_percent * out["n_words"])
            out["base_failed"] = failed
            out["quality"] = model.predict(np.array([x[1] for x in found]).reshape(len(found), len(FEATURES)))
            out["kept"] = ~failed & (out["quality"] >= limits.min_quality)
            yield out

    schema = f"doc {kind}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, quality double, kept boolean"
    return rows.toDF("doc", "t").mapInPandas(decide, schema)


def keep_good(docs: DataFrame, model: boosting.Forest, limits: Limits = Limits(), text="text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, in one pass without a join; columns stay as they are."""
    t = F.col(f"`{text}`")
    text_batches(docs)

    @F.pandas_udf("boolean")
    def keeps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [statistics(x) for x in texts]
            base = np.array([x[0] for x in found], np.int64).reshape(len(found), len(BASE))
            good = (base[:, 0] >= limits.min_words) & (100 * base[:, 4] <= limits.max_repeat_percent * base[:, 0])
            features = np.array([x[1] for x in found]).reshape(len(found), len(FEATURES))
            yield pd.Series(good & (model.predict(features) >= limits.min_quality))

    return replacing(docs.where(keeps(t))) if docs.columns else docs
