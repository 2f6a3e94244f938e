"""URL verdicts: longest matching host and path rule, else a weighted vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm.common import LOWER, UPPER, ascii_lower, replacing, text_batches


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, where the path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: (term, weight). A term of weight STRICT rejects alone.
STRICT, SOFT = 2, 1
VOCABULARY = (
    ("blackjack", STRICT), ("camgirls", STRICT), ("casino", STRICT), ("cialis", STRICT), ("escorts", STRICT), ("hentai", STRICT), ("porn", STRICT), ("porno", STRICT),
    ("viagra", STRICT), ("warez", STRICT), ("xxx", STRICT),
    ("adult", SOFT), ("ads", SOFT), ("bet", SOFT), ("bets", SOFT), ("bingo", SOFT), ("bonus", SOFT), ("cheap", SOFT), ("clickbait", SOFT), ("coupon", SOFT), ("crack", SOFT), ("dating", SOFT),
    ("farm", SOFT), ("free", SOFT), ("gambling", SOFT), ("jackpot", SOFT), ("keygen", SOFT), ("loans", SOFT), ("lottery", SOFT), ("nude", SOFT), ("pills", SOFT), ("poker", SOFT),
    ("replica", SOFT), ("sex", SOFT), ("slots", SOFT), ("spam", SOFT), ("torrent", SOFT), ("track", SOFT), ("win", SOFT),
)
MIN_SOFT = 2
#: Rules that are written out as an expression; more are looked up by host in a table that every executor gets.
WRITTEN_OUT = 32
#: Entries that a rule or vocabulary file may have.
MOST_ENTRIES = 1_000_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' if there is none."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' if there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


class RuleTable:
    """Rules by host, each host's longest paths first."""

    def __init__(self, rules: Sequence[Rule]):
        self.paths: dict[str, list[tuple[str, str, str]]] = {}
        for r in sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True):
            self.paths.setdefault(r.host, []).append((r.path, r.name, r.action))

    def find(self, host: str | None, path: str | None) -> tuple[str | None, str | None]:
        """(name, action) of the longest rule of the host or a domain above it whose path the url's starts with."""
        best, at = None, host
        while host is not None and at is not None:
            fit = next((p for p in self.paths.get(at, ()) if (path or "").startswith(p[0])), None)
            if fit and (best is None or (len(fit[1]), fit[1]) > (len(best[1]), best[1])):
                best = fit
            at = at.partition(".")[2] if "." in at else None
        return (best[1], best[2]) if best else (None, None)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(name, action), else null: in generated code if the rules are few."""
    if len(rules) > WRITTEN_OUT:
        rule_table = RuleTable(rules)

        @F.pandas_udf("struct<name:string,action:string>")
        def look_up(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([rule_table.find(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["name", "action"], dtype=object)

        found = look_up(host, path)
        return F.when(found["name"].isNotNull(), found)
    found = F.lit(None).cast("struct<name:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def _entries(spark: SparkSession, path: str, most: int) -> list[list[str]]:
    lines = spark.read.text(path).select(F.btrim("value").alias("v")).where("v <> '' and v not like '#%'").limit(most + 1).collect()
    if len(lines) > most:
        raise ValueError(f"{path} has more than {most} entries")
    return [r["v"].split() for r in lines]


def read_rules(spark: SparkSession, path: str, most: int = MOST_ENTRIES) -> list[Rule]:
    """Rules of a file of lines such as ``block example.com/de/``; at most ``most``, else an error. # starts a comment."""
    found = []
    for action, name in _entries(spark, path, most):
        host, slash, rest = name.partition("/")
        if action not in ("allow", "block") or not host:
            raise ValueError(f"no rule: {action} {name}")
        found.append(Rule(action, host.lower(), slash + rest))
    return found


def read_vocabulary(spark: SparkSession, path: str, most: int = MOST_ENTRIES) -> list[tuple[str, int]]:
    """Terms of a file of lines such as ``casino strict``; at most ``most``, else an error. # starts a comment."""
    weights = {"strict": STRICT, "soft": SOFT}
    return [(term.lower(), weights[weight]) for term, weight in _entries(spark, path, most)]


@lru_cache(maxsize=8)
def _automaton(vocabulary: tuple):
    a = ahocorasick.Automaton()
    for i, (term, weight) in enumerate(vocabulary):
        a.add_word(term, (i, len(term), weight))
    a.make_automaton()
    return a


_FOLD = str.maketrans(UPPER, LOWER)
_INSIDE = frozenset(LOWER + "0123456789")


def hits(url: str | None, vocabulary: tuple = VOCABULARY) -> tuple[int, int]:
    """Distinct strict and soft terms that stand in ``url`` with no ASCII letter or digit beside them."""
    if not url:
        return 0, 0
    text = url.translate(_FOLD)
    strict, soft = set(), set()
    for end, (i, size, weight) in _automaton(vocabulary).iter(text):
        before, after = end - size, end + 1
        if (before < 0 or text[before] not in _INSIDE) and (after >= len(text) or text[after] not in _INSIDE):
            (strict if weight >= STRICT else soft).add(i)
    return len(strict), len(soft)


def vocabulary_hits(url: Column, vocabulary: tuple = VOCABULARY) -> Column:
    vocabulary = tuple(map(tuple, vocabulary))

    @F.pandas_udf("struct<strict:int,soft:int>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            yield pd.DataFrame([hits(u, vocabulary) for u in urls], columns=["strict", "soft"])

    return count(url)


def judge_urls(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    vocabulary: Sequence[tuple[str, int]] = VOCABULARY,
    min_soft: int = MIN_SOFT,
    url: str = "url",
) -> DataFrame:
    """``df`` with host, path, rule, verdict, strict_terms and soft_terms; one row per input row.

    The longest rule that fits decides. Without one, a url is blocked if it holds one strict term
    or ``min_soft`` distinct soft terms, each bounded by something other than ASCII letters and
    digits. Null or empty urls have empty host and path, no term, and are allowed. Repeated rows
    are judged alike; input columns named like a result column are replaced. There is no shuffle.
    """
    if vocabulary and any(not t for t, _ in vocabulary):
        raise ValueError("a vocabulary term may not be empty")
    vocabulary = tuple(vocabulary) or (("\0", STRICT),)
    u = F.col(f"`{url}`")
    found = text_batches(df).withColumn("__hits", vocabulary_hits(u, vocabulary))
    host, path = host_of(u), path_of(u)
    rule = rule_of(host, path, rules)
    strict, soft = F.col("__hits.strict"), F.col("__hits.soft")
    own = F.when((strict >= 1) | (soft >= min_soft), "block").otherwise("allow")
    out = replacing(
        found, host=host, path=path, rule=rule["name"], verdict=F.coalesce(rule["action"], own),
        strict_terms=strict.cast("long"), soft_terms=soft.cast("long"),
    )
    return out.drop("__hits")
