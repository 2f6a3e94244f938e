"""Token counts under a unigram model, with forward scores shared along a trie of pre-tokens.

A pre-token is a word with its leading space mark. Its best segmentation into vocabulary pieces has
the largest sum of piece scores, found by dynamic programming from left to right; the best score of a
prefix doesn't depend on what follows. So the distinct pre-tokens are inserted in a trie whose nodes
hold the best score and token count of the way to them: a prefix is scored once, when its node is
made, for all words below it. A word's terminal holds its counts, and texts sum what the terminals of
their words hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from siltmill.llm.common import needed, text_batches

VOCABULARY = "piece_bpe_32k.model"
#: Stands for a space in front of a word.
MARK = "▁"
#: Score of pieces that the file marks as never made by merging.
NEVER = -1e9
#: Nodes of a Python worker's trie; beyond, it starts a new one. Only time depends on it.
NODES = 1_000_000
#: Longer words have no trie nodes: they are scored whole, holding only as many places as a piece is long.
SHARED = 256


class Unigram:
    """Pieces with their scores. A character that no piece covers costs one token per byte of its UTF-8
    form, each at ``unknown``, which is below all scores but NEVER."""

    def __init__(self, score: dict[str, float]):
        self.score = score
        #: Every end of a piece: its score if it is a piece, else None. What is in here may grow to the left.
        self.ends = {p[i:]: None for p in score for i in range(len(p))} | score
        self.longest = max(map(len, score), default=1)
        self.unknown = min((s for s in score.values() if s > NEVER), default=0.0) - 10.0

    def step(self, word: str, end: int, best: list[float], tokens: list[int], first: int) -> tuple[float, int]:
        """Best score and its tokens of ``word[:end]``, from those of shorter prefixes: ``best[i - first]`` is that of
        the first i characters. Equal scores take fewer tokens."""
        last = word[end - 1]
        size = 1 if last < "\x80" else len(last.encode("utf-8", "surrogatepass"))
        top, count, get, no = best[end - 1 - first] + size * self.unknown, tokens[end - 1 - first] + size, self.ends.get, -1
        for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
            s = get(word[start:end], no)
            if s is no:
                break
            if s is not None:
                s += best[start - first]
                if s > top or (s == top and tokens[start - first] + 1 < count):
                    top, count = s, tokens[start - first] + 1
        return top, count

    def whole(self, word: str) -> tuple[int, float]:
        """(tokens, score) of a word of any length, without a trie."""
        best, tokens, first = [0.0], [0], 0
        for end in range(1, len(word) + 1):
            top, count = self.step(word, end, best, tokens, first)
            best.append(top)
            tokens.append(count)
            if len(best) > 4096 + self.longest:
                cut = len(best) - self.longest - 1
                del best[:cut], tokens[:cut]
                first += cut
        return tokens[-1], best[-1]


class Trie:
    """Nodes in the order of their making; ``child`` is the way from a node by a character. ``terminal`` has the
    node of each word that was inserted."""

    def __init__(self, model: Unigram):
        self.model = model
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        node, at, path = 0, 0, [0]
        child, best, tokens = self.child, self.best, self.tokens
        for at, c in enumerate(word):  # noqa: B007
            found = child.get((node, c))
            if found is None:
                break
            node = found
            path.append(node)
        if len(path) <= len(word):
            own, counts = [best[p] for p in path], [tokens[p] for p in path]
            for end in range(at + 1, len(word) + 1):
                top, count = self.model.step(word, end, own, counts, 0)
                own.append(top)
                counts.append(count)
                child[node, word[end - 1]] = node = len(best)
                best.append(top)
                tokens.append(count)
        self.terminal[word] = node
        return node

    def counts(self, words: set[str]) -> dict[str, tuple[int, float]]:
        """(tokens, score) at the terminal of each word."""
        if len(self.best) > NODES:
            self.__init__(self.model)
        found, get = {}, self.terminal.get
        for word in words:
            if len(word) > SHARED:
                found[word] = self.model.whole(word)
            else:
                node = get(word)
                node = self.insert(word) if node is None else node
                found[word] = (self.tokens[node], self.best[node])
        return found


@lru_cache(maxsize=2)
def _model(path: str) -> Unigram:
    """Pieces and scores as the file carries them; control, unknown and byte pieces are none."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return Unigram({sp.id_to_piece(i): sp.get_score(i) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))})


@lru_cache(maxsize=2)
def _trie(path: str) -> Trie:
    return Trie(_model(path))


def pretokens(text: str | None) -> list[str]:
    """Words between ASCII white space, each after a space mark."""
    if not text:
        return []
    return [MARK + w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def token_counts(docs: DataFrame, vocabulary: str | None = None, doc="doc_id", text="text") -> DataFrame:
    """``(doc, n_pretokens, n_tokens, log_score)``, a row for each row of ``docs``; zeros for null, empty
    and blank texts.

    Words of any length are segmented whole; equal scores take fewer tokens. Repeated rows get equal
    results. Other columns are ignored, whatever their names; an empty table gives no row. Nothing is shuffled.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = text_batches(needed(docs, *dict.fromkeys((doc, text))))
    kind = rows.schema[doc].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _trie(path)
        for b in batches:
            cut = [pretokens(t) for t in b["t"]]
            get = trie.counts({w for words in cut for w in words}).__getitem__
            out = []
            for d, words in zip(b["doc"], cut, strict=True):
                found = list(map(get, words))
                out.append((d, len(words), sum(f[0] for f in found), math.fsum(f[1] for f in found)))
            yield pd.DataFrame(out, columns=["doc", "n_pretokens", "n_tokens", "log_score"])

    return rows.toDF("doc", "t").mapInPandas(count, f"doc {kind}, n_pretokens long, n_tokens long, log_score double")
