"""Secret scans: fixed patterns, and a character convolutional network over every other candidate.

The network sees a candidate and the characters around it. It is trained here, in numpy, on labelled
findings: those of the corpus, where the patterns say what is a secret and what else looks like one, and
made-up ones of formats that the corpus may lack. Its scores are calibrated on findings it has not
seen, and the threshold is the highest that keeps a stated recall on them. Every candidate is scored, pattern
findings included; these stay whatever their score.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.llm.common import needed, text_batches

KINDS = ("assign", "access", "hex", "cnn")
#: Fixed patterns. "drop failing": matches that are too short are dropped after matching.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: A candidate: a run of these characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

LEFT, BODY, RIGHT = 20, 48, 8
LENGTH = LEFT + BODY + RIGHT
#: Characters between the windows of a candidate that is longer than BODY, and windows scored at a time.
STRIDE, SCORED = 24, 4096
#: Symbols: 0 padding, 1 other, 2.. printable ASCII.
_CODE = np.ones(128, np.int64)
for _i, _c in enumerate(string.printable[:95]):
    _CODE[ord(_c)] = 2 + _i
SYMBOLS = 97


def base_findings(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, where the secret itself starts) of the pattern findings, in order."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern findings, in order."""
    return [f[:3] for f in base_findings(text)]


def candidates(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]


def open_candidates(text: str, base: list[tuple[int, int, str, int]]) -> Iterator[tuple[int, int]]:
    """The candidates that overlap no pattern finding."""
    k, reach = 0, 0
    for s, e in candidates(text):
        while k < len(base) and base[k][0] < e:  # both are in order of their starts
            reach, k = max(reach, base[k][1]), k + 1
        if s >= reach:
            yield s, e


def window(text: str, start: int, end: int) -> tuple[str, str, str]:
    """What the network sees: left context, candidate (its beginning if it is longer than BODY), right context."""
    return text[max(0, start - LEFT) : start], text[start : min(end, start + BODY)], text[end : end + RIGHT]


_PART = re.compile(r"[^/=]{16,}")


def windows(text: str, start: int, end: int) -> Iterator[tuple[str, str, str]]:
    """All of a candidate, by windows: its beginning; if it is longer than BODY, also one at every STRIDE
    characters up to its end, and the windows of its parts between ``/`` and ``=``."""
    yield window(text, start, end)
    if end - start > BODY:
        for s in (*range(start + STRIDE, end - BODY, STRIDE), end - BODY):
            yield window(text, s, min(end, s + BODY))
        for m in _PART.finditer(text, start, end):
            if (m.start(), m.end()) != (start, end):
                yield from windows(text, m.start(), m.end())


def encode(windows: Sequence[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol ids and the mark of the candidate's places, (n, LENGTH) each."""
    ids = np.zeros((len(windows), LENGTH), np.int64)
    mark = np.zeros((len(windows), LENGTH), np.float32)
    for row, (left, body, right) in enumerate(windows):
        for part, at in ((left, LEFT - len(left)), (body, LEFT), (right, LEFT + BODY)):
            codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
            ids[row, at : at + len(codes)] = np.where(codes < 128, _CODE[np.minimum(codes, 127)], 1)
        mark[row, LEFT : LEFT + len(body)] = 1
    return ids, mark


@dataclass
class Network:
    """Embedding, one convolution of ``width`` characters, maximum and mean over places, one logit;
    ``scale`` and ``shift`` calibrate it and ``threshold`` is on the calibrated probability."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    out: float
    width: int
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    #: Of the findings held back: how many, recall and precision at the threshold, and mean squared error of the probability.
    report: dict[str, float] | None = None

    def _forward(self, ids: np.ndarray, mark: np.ndarray):
        x = np.concatenate([self.embed[ids], mark[:, :, None]], axis=2)
        n, length, d = x.shape
        m = length - self.width + 1
        cols = np.lib.stride_tricks.sliding_window_view(x, self.width, axis=1).transpose(0, 1, 3, 2).reshape(n, m, self.width * d)
        z = cols @ self.kernel + self.bias
        a = np.maximum(z, 0)
        pooled = np.concatenate([a.max(axis=1), a.mean(axis=1)], axis=1)
        return cols, z, a, pooled, pooled @ self.head + self.out

    def logits(self, ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
        parts = [self._forward(ids[i : i + 512], mark[i : i + 512])[-1] for i in range(0, len(ids), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, windows: Sequence[tuple[str, str, str]]) -> np.ndarray:
        if not windows:
            return np.zeros(0)
        z = self.scale * self.logits(*encode(windows)) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(
    findings: Sequence[tuple[tuple[str, str, str], int]], recall: float = 0.98, epochs: int = 5, filters: int = 16,
    width: int = 5, dim: int = 8, rate: float = 0.01, seed: int = 7,
) -> Network:
    """A network for ``findings``, (window, label) pairs of which every fourth calibrates.

    ``recall`` is what the threshold must keep on the calibration findings.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(findings))
    held = order[::4]
    fit = np.setdiff1d(order, held)
    fit = fit[rng.permutation(len(fit))]
    ids, mark = encode([w for w, _ in findings])
    y = np.array([label for _, label in findings], np.float32)
    net = Network(
        rng.normal(0, 0.3, (SYMBOLS, dim)).astype(np.float32), rng.normal(0, 0.2, (width * (dim + 1), filters)).astype(np.float32),
        np.zeros(filters, np.float32), rng.normal(0, 0.3, 2 * filters).astype(np.float32), 0.0, width,
    )
    net.embed[0] = 0
    params = {"embed": net.embed, "kernel": net.kernel, "bias": net.bias, "head": net.head, "out": np.zeros(1, np.float32)}
    m1, m2, t = {k: np.zeros_like(v) for k, v in params.items()}, {k: np.zeros_like(v) for k, v in params.items()}, 0
    for _ in range(epochs):
        for i in range(0, len(fit), 64):
            b = fit[i : i + 64]
            cols, z, a, pooled, logit = net._forward(ids[b], mark[b])
            n, m, f = z.shape
            d = (_sigmoid(logit) - y[b]) / len(b)
            g = {"head": pooled.T @ d, "out": np.array([d.sum()])}
            dp = d[:, None] * net.head[None]
            da = np.repeat(dp[:, None, f:] / m, m, axis=1)
            top = a.argmax(axis=1)
            np.add.at(da, (np.arange(n)[:, None], top, np.arange(f)[None]), dp[:, :f])
            dz = da * (z > 0)
            g["kernel"] = np.tensordot(cols, dz, axes=([0, 1], [0, 1]))
            g["bias"] = dz.sum(axis=(0, 1))
            dc = (dz @ net.kernel.T).reshape(n, m, width, dim + 1)
            dx = np.zeros((n, LENGTH, dim), np.float32)
            for k in range(width):
                dx[:, k : k + m] += dc[:, :, k, :dim]
            ge = np.zeros_like(net.embed)
            np.add.at(ge, ids[b].ravel(), dx.reshape(-1, dim))
            ge[0] = 0
            g["embed"], t = ge, t + 1
            for name, grad in g.items():
                m1[name] = 0.9 * m1[name] + 0.1 * grad
                m2[name] = 0.999 * m2[name] + 0.001 * grad * grad
                params[name] -= (rate * (m1[name] / (1 - 0.9**t)) / (np.sqrt(m2[name] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
            net.out = float(params["out"][0])
    z = net.logits(ids[held], mark[held]).astype(float)
    yh = y[held].astype(float)
    scale, shift = 1.0, 0.0
    for _ in range(200):  # Platt scaling, by gradient steps
        p = _sigmoid(scale * z + shift)
        scale -= 0.05 * float(((p - yh) * z).mean())
        shift -= 0.05 * float((p - yh).mean())
    net.scale, net.shift = scale, shift
    hits = np.sort(_sigmoid(scale * z + shift)[yh > 0])
    net.threshold = max(0.5, float(hits[int((1 - recall) * len(hits))])) if len(hits) else 1.1
    if len(hits) and (hits >= net.threshold).mean() < recall:
        net.threshold = float(hits[int((1 - recall) * len(hits))])
    p = _sigmoid(scale * z + shift)
    found = p >= net.threshold
    net.report = {
        "held": len(p), "secrets": int(yh.sum()), "recall": float(found[yh > 0].mean()) if (yh > 0).any() else 1.0,
        "precision": float(yh[found].mean()) if found.any() else 1.0, "squared_error": float(((p - yh) ** 2).mean()) if len(p) else 0.0,
    }
    return net


def labelled_findings(n: int = 3000, seed: int = 11) -> list[tuple[tuple[str, str, str], int]]:
    """Made-up findings: keys as services issue them, and long strings that aren't keys, each in context."""
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choices(chars, k=k))
    up, low, num, hexa = string.ascii_uppercase, string.ascii_lowercase, string.digits, "0123456789abcdef"
    every, url64 = up + low + num, up + low + num + "-_"
    syllables = "an ber con der el en er est ing ion ka la lo men mo ner no on ou pre ra re sch so ta th ti to un ver vi".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))

    def key() -> str:
        return r.choice((
            lambda: "AKIA" + pick(up + num, 16), lambda: pick(hexa, r.choice((32, 40, 64))), lambda: "gh" + r.choice("pos") + "_" + pick(every, 36),
            lambda: "sk_live_" + pick(every, 24), lambda: "sk-" + pick(every, 48), lambda: pick(every, r.randint(20, 44)),
            lambda: pick(every + "+/", r.randint(30, 43)) + "=", lambda: "xoxb-" + pick(num, 12) + "-" + pick(every, 24),
            lambda: "eyJ" + pick(url64, r.randint(30, 60)), lambda: "AIza" + pick(url64, 35), lambda: pick(up + num, r.randint(20, 32)),
        ))()

    def other() -> str:
        return r.choice((
            lambda: "-".join(word() for _ in range(r.randint(3, 6))) + "-" + str(r.randint(1, 2030)),
            lambda: "/".join(word() for _ in range(r.randint(3, 6))) + "/" + str(r.randint(1, 999)),
            lambda: f"20{r.randint(10, 29)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}h{r.randint(0, 59):02}m",
            lambda: "_".join(word() for _ in range(r.randint(3, 5))) + str(r.randint(0, 99)),
            lambda: word().title() * 1 + word().title() + word().title() + word().title() + str(r.randint(1, 99)),
            lambda: "version-" + "-".join(str(r.randint(0, 20)) for _ in range(4)) + "-beta" + str(r.randint(1, 9)),
            lambda: pick(r.choice(("a1", "x0", "-=", "ab1")), 1) * r.randint(18, 40) + "1a", lambda: (word() + "1") * r.randint(4, 8),
            lambda: "isbn-" + pick(num, 13) + "-p" + str(r.randint(1, 500)), lambda: pick(num, 16) + "km", lambda: "img_" + pick(num, 8) + "_" + pick(num, 6) + "_large",
        ))()

    def context(secret: bool) -> tuple[str, str]:
        lead = " ".join(word() for _ in range(4)) + r.choice((" ", ". ", "\n", ", "))
        if r.random() < (0.5 if secret else 0.1):
            lead += r.choice(("key: ", "auth=", 'credential = "', "Bearer ", "access key ", "private_key: ", "pwd: ", "AUTH "))
        return lead[-LEFT:], r.choice((" ", '"', ".", ",", "\n", "; ")) + word()

    out = []
    for i in range(n):
        body = key() if i % 2 else other()
        if len(body) < 16:
            continue
        left, right = context(bool(i % 2))
        out.append((window(left + body + right, len(left), len(left) + len(body)), i % 2))
    return out


@lru_cache(maxsize=1)
def default_network() -> Network:
    return train(labelled_findings())


def corpus_findings(docs: DataFrame, most: int = 2000, text="text") -> list[tuple[tuple[str, str, str], int]]:
    """At most ``most`` distinct secrets and as many other candidates of the whole corpus, by a hash of what the network
    sees, with the windows of each: what the patterns find is a secret, and a candidate that they leave is none."""
    rows = text_batches(needed(docs, text)).toDF("t")

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["t"]:
                t = t or ""
                base = base_findings(t)
                out += [(1, *window(t, v, e)) for _, e, _, v in base if e - v >= 16]
                out += [(0, *w) for s, e in open_candidates(t, base) for w in windows(t, s, e)]
            yield pd.DataFrame(out, columns=["y", "a", "b", "c"])

    seen = rows.mapInPandas(label, "y int, a string, b string, c string").distinct()
    out = []
    for y in (0, 1):
        some = seen.where(F.col("y") == y).orderBy(F.xxhash64("a", "b", "c"), "a", "b", "c").limit(most).collect()
        out += [((r["a"], r["b"], r["c"]), y) for r in some]
    return out


def fit(docs: DataFrame, most: int = 2000, recall: float = 0.98, text="text") -> Network:
    """A network for the findings of ``docs`` and made-up ones; see ``corpus_findings`` for the bound."""
    return train(corpus_findings(docs, most, text) + labelled_findings(), recall)


def scan(docs: DataFrame, network: Network | None = None, doc="doc_id", text="text") -> DataFrame:
    """``(doc, findings array<struct<start,end,kind,score>>, n_scored)``, a row for each row of ``docs``.

    Pattern findings all stay, with the network's score of their secret. A candidate that overlaps none of them
    is found, as kind ``cnn``, if the highest score of the windows that cover it is at the threshold or
    more; n_scored counts the findings and candidates scored. Starts and ends are in code points, ends exclusive. Null and
    empty texts have no finding; texts of any length are read whole; repeated rows get equal results.
    Other columns are ignored, whatever their names; an empty table gives no row. Nothing is shuffled.
    """
    net = network or default_network()
    rows = text_batches(needed(docs, *dict.fromkeys((doc, text))))
    kind = rows.schema[doc].dataType.simpleString()

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            asked: list[tuple[int, int, int, str]] = []
            best: list[float] = []
            seen: list[tuple[str, str, str]] = []
            whose: list[int] = []

            def score() -> None:
                for k, p in zip(whose, net.probability(seen), strict=True):  # noqa: B023
                    best[k] = max(best[k], float(p))  # noqa: B023
                seen.clear()  # noqa: B023
                whose.clear()  # noqa: B023

            for i, t in enumerate(b["t"]):
                t = t or ""
                base = base_findings(t)
                spans = [(s, e, k, v) for s, e, k, v in base] + [(s, e, "cnn", s) for s, e in open_candidates(t, base)]
                for s, e, k, v in spans:
                    asked.append((i, s, e, k))
                    best.append(0.0)
                    for w in windows(t, v, e):
                        seen.append(w)
                        whose.append(len(best) - 1)
                        if len(seen) == SCORED:
                            score()
            score()
            found: list[list] = [[] for _ in range(len(b))]
            scored = np.zeros(len(b), np.int64)
            for (i, s, e, k), p in zip(asked, best, strict=True):
                scored[i] += 1
                if k != "cnn" or p >= net.threshold:
                    found[i].append({"start": s, "end": e, "kind": k, "score": p})
            for f in found:
                f.sort(key=lambda x: (x["start"], KINDS.index(x["kind"])))
            yield pd.DataFrame({"doc": b["doc"], "findings": found, "n_scored": scored})

    return rows.toDF("doc", "t").mapInPandas(find, f"doc {kind}, findings array<struct<start:long,end:long,kind:string,score:double>>, n_scored long")


def sha256_of(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
