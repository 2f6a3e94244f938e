"""Language identification: a linear-chain conditional random field labels every word.

Words have character n-gram, affix and lexicon features, hashed into a weight table; transitions
between the languages of neighbouring words are learned with them. Forward-backward over the whole
text gives each word's marginal probabilities, and the text's language is the one with the largest
sum. Everything is numpy over batches of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.llm.common import needed, runs, text_batches

#: Runs of letters of any script and of numbers that aren't digits, such as a half or a Roman numeral's sign.
_RUN = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
BUCKETS = 1 << 16
#: Words of a block of forward-backward, words whose scores a Python worker remembers, and characters tagged at once.
BLOCK, REMEMBERED, HELD = 32, 150_000, 500_000


@dataclass(frozen=True)
class Fit:
    """Learning uses at most ``max_texts`` texts (those with the smallest hash of their id)."""

    max_texts: int = 4000
    sequences: int = 5000
    length: int = 32
    epochs: int = 3
    rate: float = 0.15
    lexicon_min: int = 3
    seed: int = 5


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode categories L), in lower case."""
    low = text.lower()
    words = _RUN.findall(low)
    if all(map(str.isalpha, words)):
        return words
    return "".join(c if c.isalpha() else " " for c in low).split()


def _mix(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(1469598103934665603)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p, np.uint64)) * np.uint64(1099511628211)
            h = h ^ (h >> np.uint64(29))
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, word it belongs to): bigrams, trigrams, and affixes of two to four characters."""
    text = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    out, who = [], []

    def add(places: np.ndarray, n: int, salt: int) -> None:
        places = places[places + n <= len(c)]
        places = places[owner[places] == owner[places + n - 1]]
        out.append(_mix(salt, *(c[places + i] for i in range(n))))
        who.append(owner[places])

    every = np.arange(len(c))
    add(every, 2, 1)
    add(every, 3, 2)
    for n in (3, 4, 5):
        add(first, n, 10 + n)
        add((first + size - n)[size >= n], n, 20 + n)
    return np.concatenate(out), np.concatenate(who)


@dataclass
class Field:
    """``weights`` (BUCKETS, k), ``lexicon`` word -> row of ``entries`` (rows, k), ``transitions`` (k, k), ``start`` (k)."""

    languages: tuple[str, ...]
    weights: np.ndarray
    lexicon: dict[str, int]
    entries: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of distinct ``words``, (n, k)."""
        if not words:
            return np.zeros((0, len(self.languages)))
        bucket, who = features(words)
        k = len(self.languages)
        total = np.stack([np.bincount(who, self.weights[bucket, j], len(words)) for j in range(k)], axis=1)
        rows = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        total[rows >= 0] += self.entries[rows[rows >= 0]]
        return total

    def marginals(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Marginal probabilities (n, k) of texts that follow each other in ``scores`` with ``sizes`` words each.

        Exact for any length: each block's transfer matrix is built for all blocks at once, the blocks
        of a text are chained, and a second pass inside the blocks gives the marginals.
        """
        n, k = scores.shape
        if not n:
            return np.zeros((0, k))
        e = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -30, 0))
        a = np.exp(self.transitions - self.transitions.max())
        blocks = -(-sizes // BLOCK)
        nb = int(blocks.sum())
        text_of = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(nb) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        count = np.minimum(BLOCK, sizes[text_of] - nth * BLOCK)
        grid = begin[:, None] + np.arange(BLOCK)
        inside = np.arange(BLOCK) < count[:, None]
        em = np.where(inside[:, :, None], e[np.minimum(grid, n - 1)], 1.0)
        opening = np.exp(self.start - self.start.max())
        transfer = np.broadcast_to(np.eye(k), (nb, k, k)).copy()
        for t in range(BLOCK):
            live = inside[:, t]
            step = a if t else np.where((nth == 0)[:, None, None], np.eye(k), a)
            moved = (transfer @ step) * em[:, t, None, :]
            moved /= moved.sum(axis=(1, 2), keepdims=True)
            transfer = np.where(live[:, None, None], moved, transfer)
        inward = np.zeros((nb, k))  # forward weights before each block's first word
        outward = np.ones((nb, k))  # backward weights after each block's last word
        place = np.cumsum(blocks) - blocks
        for j in range(int(blocks.max())):
            at = place[blocks > j] + j
            inward[at] = opening if j == 0 else (inward[at - 1][:, None, :] @ transfer[at - 1])[:, 0]
            inward[at] /= inward[at].sum(axis=1, keepdims=True)
        for j in range(int(blocks.max()) - 2, -1, -1):
            at = place[blocks > j + 1] + j
            outward[at] = (transfer[at + 1] @ outward[at + 1][:, :, None])[:, :, 0]
            outward[at] /= outward[at].sum(axis=1, keepdims=True)
        forward, now = np.empty((nb, BLOCK, k)), inward
        for t in range(BLOCK):
            now = (now @ a if t else np.where((nth == 0)[:, None], now, now @ a)) * em[:, t]
            now = now / now.sum(axis=1, keepdims=True)
            forward[:, t] = now
        back, result = outward.copy(), np.zeros((n, k))
        for t in range(BLOCK - 1, -1, -1):
            live = inside[:, t]
            p = forward[:, t] * back
            result[grid[live, t]] = p[live] / p[live].sum(axis=1, keepdims=True)
            moved = (em[:, t] * back) @ a.T
            back = np.where(live[:, None], moved / moved.sum(axis=1, keepdims=True), back)
        return result


def learn(texts: list[tuple[str, str]], fit: Fit = Fit()) -> Field | None:
    """A field fitted on ``(text, language)`` pairs; None without any.

    Training sequences are code-switched: runs of words of different texts follow each other, each word
    labelled with the language of its text, so that transitions are learned as well.
    """
    texts = [(words_of(t), lang) for t, lang in texts if t and lang is not None]
    texts = [(w, lang) for w, lang in texts if w]
    languages = tuple(sorted({lang for _, lang in texts}))
    if not languages:
        return None
    rng = np.random.default_rng(fit.seed)
    k = len(languages)
    by = [[w for w, lang in texts if lang == name] for name in languages]
    counts: dict[str, int] = {}
    for w, _ in texts:
        for x in set(w):
            counts[x] = counts.get(x, 0) + 1
    lexicon = {w: i for i, w in enumerate(sorted(w for w, c in counts.items() if c >= fit.lexicon_min))}
    words, labels = [], []
    for _ in range(fit.sequences):
        row, tags = [], []
        while len(row) < fit.length:
            lang = int(rng.integers(k))
            source = by[lang][int(rng.integers(len(by[lang])))]
            run = int(rng.integers(4, 24))
            at = int(rng.integers(max(1, len(source) - run + 1)))
            row += source[at : at + run]
            tags += [lang] * len(source[at : at + run])
        words.append(row[: fit.length])
        labels.append(tags[: fit.length])
    distinct = sorted({w for row in words for w in row})
    number = {w: i for i, w in enumerate(distinct)}
    ids = np.array([[number[w] for w in row] for row in words])
    tags = np.array(labels)
    bucket, who = features(distinct)
    ends = np.searchsorted(who, np.arange(len(distinct) + 1)) if (np.diff(who) >= 0).all() else None
    if ends is None:
        order = np.argsort(who, kind="stable")
        bucket, who = bucket[order], who[order]
        ends = np.searchsorted(who, np.arange(len(distinct) + 1))
    rows = np.array([lexicon.get(w, -1) for w in distinct])
    field = Field(languages, np.zeros((BUCKETS, k)), lexicon, np.zeros((max(1, len(lexicon)), k)), np.zeros((k, k)), np.zeros(k))
    squares = {name: np.full_like(getattr(field, name), 1e-6) for name in ("weights", "entries", "transitions", "start")}
    for _ in range(fit.epochs):
        order = rng.permutation(len(ids))
        for i in range(0, len(order), 200):
            some = order[i : i + 200]
            used, place = np.unique(ids[some], return_inverse=True)
            place = place.reshape(len(some), fit.length)
            spans = [np.arange(ends[u], ends[u + 1]) for u in used]
            feats = bucket[np.concatenate(spans)]
            owner = np.repeat(np.arange(len(used)), [len(s) for s in spans])
            score = np.stack([np.bincount(owner, field.weights[feats, j], len(used)) for j in range(k)], axis=1)
            lex = rows[used]
            score[lex >= 0] += field.entries[lex[lex >= 0]]
            emit, trans, start = _gradient(score[place], tags[some], field)
            per_word = np.stack([np.bincount(place.ravel(), emit[:, :, j].ravel(), len(used)) for j in range(k)], axis=1)
            grads = {"weights": np.zeros_like(field.weights), "entries": np.zeros_like(field.entries), "transitions": trans, "start": start}
            for j in range(k):
                grads["weights"][:, j] = np.bincount(feats, per_word[owner, j], BUCKETS)
                grads["entries"][:, j] = np.bincount(lex[lex >= 0], per_word[lex >= 0, j], len(field.entries))
            for name, g in grads.items():
                squares[name] += g * g
                setattr(field, name, getattr(field, name) - fit.rate * g / np.sqrt(squares[name]))
    return field


def _gradient(scores: np.ndarray, tags: np.ndarray, field: Field):
    """Of the negative log-likelihood, by emission, transition and start, for sequences of equal length."""
    n, length, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a = np.exp(field.transitions)
    alpha, beta = np.empty((n, length, k)), np.ones((n, length, k))
    alpha[:, 0] = np.exp(field.start) * e[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        alpha[:, t] = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    truth = np.eye(k)[tags]
    pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    trans = pair.sum(axis=(0, 1)) - np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    return p - truth, trans, (p - truth)[:, 0].sum(axis=0)


class Tagger:
    """A field with a bounded memory of word scores."""

    def __init__(self, field: Field):
        self.field, self.number, self.scores = field, {}, np.zeros((0, len(field.languages)))

    def tag(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """(words of each text, number of words of each, marginals of all words in order)."""
        words = [words_of(t) if t else [] for t in texts]
        if len(self.number) > REMEMBERED:
            self.number, self.scores = {}, self.scores[:0]
        fresh = list(dict.fromkeys(w for row in words for w in row if w not in self.number))
        if fresh:
            base = len(self.number)
            self.number.update((w, base + i) for i, w in enumerate(fresh))
            self.scores = np.concatenate([self.scores, self.field.emissions(fresh)])
        sizes = np.array([len(w) for w in words], np.int64)
        ids = np.fromiter((self.number[w] for row in words for w in row), np.int64, int(sizes.sum()))
        full = sizes > 0
        return words, sizes, self.field.marginals(self.scores[ids], sizes[full])

    def languages_of(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words, sizes, p = self.tag(texts)
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        full = np.flatnonzero(sizes)
        if len(full):
            sums = np.add.reduceat(p, np.cumsum(sizes[full]) - sizes[full], axis=0) / sizes[full][:, None]
            best = sums.argmax(axis=1)
            score[full] = np.clip(sums[np.arange(len(full)), best], 0, 1)
            for i, b in zip(full, best, strict=True):
                names[i] = self.field.languages[b]
        return names, score


def train(docs: DataFrame, fit: Fit = Fit(), doc="doc_id", text="text", lang="lang") -> Field | None:
    """Learns from at most ``fit.max_texts`` rows with a text and a language."""
    named = needed(docs, *dict.fromkeys((doc, text, lang))).toDF("doc", "t", "lang").where("doc is not null and t is not null and lang is not null")
    ids = named.select("doc").distinct().orderBy(F.xxhash64("doc"), "doc").limit(fit.max_texts)
    some = named.join(F.broadcast(ids), "doc", "left_semi").groupBy("doc").agg(F.min(F.struct("t", "lang")).alias("s"))
    found = some.select("doc", "s.t", "s.lang").toPandas().sort_values("doc")  # at most max_texts rows
    return learn(list(zip(found["t"], found["lang"], strict=True)), fit)


def predict(docs: DataFrame, field: Field | None, doc="doc_id", text="text") -> DataFrame:
    """``(doc, lang_pred, score)``, a row for each row of ``docs``, from the text alone.

    A null text, one without a letter, and any text if nothing was learned are ``und`` with score 0;
    else score is the mean marginal probability of the language over the words. Texts are read whole,
    whatever their length; repeated rows get equal results, and of languages with equal sums the first
    by name is taken. Other columns are ignored, whatever their names; an empty table gives no row.
    """
    rows = text_batches(needed(docs, *dict.fromkeys((doc, text))))
    kind = rows.schema[doc].dataType.simpleString()

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field) if field else None
        for b in batches:
            for part in runs(list(b["t"]), HELD):
                some = b.iloc[part]
                names, score = tagger.languages_of(list(some["t"])) if tagger else ([UNKNOWN] * len(some), np.zeros(len(some)))
                yield pd.DataFrame({"doc": some["doc"].to_numpy(), "lang_pred": names, "score": score})

    return rows.toDF("doc", "t").mapInPandas(decide, f"doc {kind}, lang_pred string, score double")
