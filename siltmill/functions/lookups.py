"""Taxonomy and tool lookups of a domain, as literal maps inside the plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.text import strip


@dataclass(frozen=True)
class Domain:
    """Intents with their aliases and answer templates, and rules that choose tools."""

    name: str = "default"
    intents: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    default_intent: str | None = None
    templates: dict[str, str] = field(default_factory=dict)
    tools: tuple[str, ...] = ()
    intent_tools: dict[str, tuple[str, ...]] = field(default_factory=dict)
    scenario_tools: dict[str, tuple[str, ...]] = field(default_factory=dict)
    default_tools: tuple[str, ...] = ()
    generic_tools: tuple[str, ...] = ()
    tool_hints: dict[str, str] = field(default_factory=dict)


# The intents of the health domain and the older names they go by.
HEALTH = Domain(
    name="health",
    intents=("食疗咨询", "运动指导", "体质辨识", "症状调理", "情志调节", "其他"),
    aliases={"食材食疗查询": "食疗咨询", "运动功法": "运动指导", "体质辨识咨询": "体质辨识", "症状调理建议": "症状调理", "情志调节指导": "情志调节"},
    default_intent="其他",
)


def literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv)) if d else F.create_map().cast("map<string,string>")


def resolve(domain: Domain, with_default: bool = False):
    """Column -> canonical intent; unknown or blank ones are null, or the domain's default."""

    def to(c: Column) -> Column:
        name = strip(c)
        name = F.coalesce(F.try_element_at(literal_map(domain.aliases), name), name) if domain.aliases else name
        known = F.when(name.isin(*domain.intents), name)
        return F.coalesce(known, F.lit(domain.default_intent)) if with_default else known

    return to


def template(domain: Domain, intent: Column, fallback: str = "其他") -> Column:
    return F.coalesce(F.try_element_at(literal_map(domain.templates), intent), F.lit(domain.templates.get(fallback)))


def _names(names) -> Column:
    return F.array(*(F.lit(n) for n in names)).cast("array<string>")


def required_tools(domain: Domain, fields: list[Column], intent: Column, scenario: Column) -> Column:
    """Tools a sample names, then those of its intent, then of each scenario rule whose key its scenario
    contains; the default tools if there are none. In that order, distinct, and only known tools."""
    none = _names(())
    parts = [F.coalesce(f, none) for f in fields]
    parts.append(F.coalesce(*(F.when(intent == i, _names(t)) for i, t in domain.intent_tools.items()), none) if domain.intent_tools else none)
    parts += [F.when(F.contains(F.coalesce(scenario, F.lit("")), F.lit(k)), _names(t)).otherwise(none) for k, t in domain.scenario_tools.items()]
    found = F.array_intersect(F.array_distinct(F.concat(*parts)), _names(domain.tools))
    return F.when(F.size(found) > 0, found).otherwise(F.array_intersect(_names(domain.default_tools), _names(domain.tools)))


def irrelevant_tools(domain: Domain, related: Column, required: Column) -> Column:
    """The catalog without related and generic tools; if that leaves none, without the required ones only."""
    strict = F.array_except(F.array_except(_names(domain.tools), related), _names(domain.generic_tools))
    return F.when(F.size(strict) > 0, strict).otherwise(F.array_except(_names(domain.tools), required))


def hinted_intent(domain: Domain, names: Column) -> Column:
    """The intent that the called tools point to, if they agree."""
    hints = F.array_distinct(F.array_compact(F.transform(names, lambda n: F.try_element_at(literal_map(domain.tool_hints), n))))
    return F.when(F.size(hints) == 1, F.element_at(hints, 1))
