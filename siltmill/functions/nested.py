"""Expressions over trajectories: arrays of steps with planner output and observations.

A step has the type STEP; ``read_steps`` brings older shapes (a single ``tool_call`` or
``observation`` object, an object where an array belongs) to it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.text import compose_reasoning, once, strip, truncate

CALL = "struct<id:string,name:string,arguments:string>"
OBSERVATION = "struct<tool_call_id:string,name:string,content:string,error:boolean>"
OUTPUT = f"struct<intent:string,action:string,ask:string,finish_reason:string,tool_calls:array<{CALL}>>"
RAW = "struct<reasoning_content:string,raw_content:string,content:string>"
STEP = f"struct<step:int,planner_output:{OUTPUT},planner_raw_output:{RAW},planner_overridden:boolean,observations:array<{OBSERVATION}>>"
# A step's fields as JSON text: one parse a step instead of one a field.
FIELDS = (
    "struct<step:string,planner_output:struct<intent:string,action:string,ask:string,finish_reason:string,tool_calls:string,tool_call:string>,"
    "planner_raw_output:string,planner_overridden:string,observations:string,observation:string>"
)
MESSAGE = "struct<role:string,content:string,tool_calls:array<struct<name:string,arguments:string>>>"

# Fixed values.
FORBIDDEN = ("write_file",)
NO_INFO = "无外部补充信息。"
FAILED = "（工具失败）"
OTHER_INTENT = "其他"


def plural(many: Column, one: Column, item: str) -> Column:
    """An array of objects from JSON text that holds an array or a single object; if that is empty, the older
    single field. Elements that aren't objects are dropped."""
    none = F.array().cast("array<string>")
    listed = once(many, lambda m: F.coalesce(F.when(m.startswith("["), F.from_json(m, "array<string>")).when(m.startswith("{"), F.array(m)), none))
    items = once(listed, lambda m: F.when(F.size(m) > 0, m).when(one.startswith("{"), F.array(one)).otherwise(none))
    return F.transform(F.filter(items, lambda x: x.startswith("{")), lambda x: F.from_json(x, item))


def read_steps(trajectory: Column) -> Column:
    """array<STEP> from the JSON text of a trajectory; elements that aren't objects are dropped."""
    items = F.array_compact(F.transform(F.from_json(trajectory, "array<string>"), lambda s: F.when(s.startswith("{"), s)))

    def step(w: Column) -> Column:
        out = w["planner_output"]
        output = F.struct(
            *(out[k].alias(k) for k in ("intent", "action", "ask", "finish_reason")), plural(out["tool_calls"], out["tool_call"], CALL).alias("tool_calls"),
        )
        return F.struct(
            w["step"].try_cast("int").alias("step"), output.alias("planner_output"), F.from_json(w["planner_raw_output"], RAW).alias("planner_raw_output"),
            F.coalesce(w["planner_overridden"].try_cast("boolean"), F.lit(False)).alias("planner_overridden"),
            plural(w["observations"], w["observation"], OBSERVATION).alias("observations"),
        )

    return F.transform(F.transform(items, lambda s: F.from_json(s, FIELDS)), step)


def has_forbidden_call(output: Column, names=FORBIDDEN) -> Column:
    return F.coalesce(F.exists(output["tool_calls"], lambda c: c["name"].isin(*names)), F.lit(False))


def exposed_tools(raw: Column, catalog: str = "[]", names=FORBIDDEN) -> Column:
    """array<variant>: the tools that a row exposes, whole, without forbidden ones. A row without the field has those of
    ``catalog`` (JSON); an empty list is no absent field, and anything but a list is an empty one."""
    absent = ~F.coalesce(F.array_contains(F.json_object_keys(raw), "tools"), F.lit(False))
    listed = F.try_variant_get(F.try_parse_json(F.when(absent, F.concat(F.lit('{"tools": '), F.lit(catalog), F.lit("}"))).otherwise(raw)), "$.tools", "array<variant>")
    name = lambda t: F.coalesce(F.try_variant_get(t, "$.function.name", "string"), F.lit(""))
    return F.coalesce(F.filter(listed, lambda t: ~name(t).isin(*names)), F.array().cast("array<variant>"))


def until_forbidden(steps: Column, names=FORBIDDEN) -> Column:
    """The steps before the first with a forbidden call."""
    bad = F.array_position(F.transform(steps, lambda s: has_forbidden_call(s["planner_output"], names)), True)
    return F.when(bad > 0, F.slice(steps, F.lit(1), bad.cast("int") - 1)).otherwise(steps)


def _quote(c: Column) -> Column:
    """JSON text of a string, or null."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null"))


def payload(output: Column) -> Column:
    """Intent and action, and the ask or finish reason that goes with the action, as spaced JSON."""
    item = lambda name, c: F.concat(F.lit(f'"{name}": '), F.when(c.isNull(), F.lit("null")).otherwise(_quote(c)))
    action = output["action"]
    parts = F.concat_ws(
        ", ", item("intent", output["intent"]), item("action", action),
        F.when(action == "ask_clarification", item("ask", output["ask"])).when(action == "planning_finish", item("finish_reason", output["finish_reason"])),
    )
    return F.concat(F.lit("{"), parts, F.lit("}"))


def assistant_content(step: Column, reasoning: bool = True) -> Column:
    body = payload(step["planner_output"])
    return compose_reasoning(step["planner_raw_output"]["reasoning_content"], body) if reasoning else body


def _message(role: str, content: Column, calls: Column | None = None) -> Column:
    none = F.lit(None).cast("array<struct<name:string,arguments:string>>")
    return F.struct(F.lit(role).alias("role"), content.alias("content"), (none if calls is None else calls).alias("tool_calls"))


def own_message(step: Column, reasoning: bool = True) -> Column:
    """The assistant's message of a step, with its calls if it calls tools."""
    calls = F.transform(step["planner_output"]["tool_calls"], lambda c: F.struct(c["name"].alias("name"), F.coalesce(c["arguments"], F.lit("{}")).alias("arguments")))
    calls = F.when(step["planner_output"]["action"] == "tool_call", calls)
    return _message("assistant", assistant_content(step, reasoning), calls)


def step_messages(step: Column, reasoning: bool = True) -> Column:
    """All messages a finished step leaves in the history."""
    told = F.transform(step["observations"], lambda o: _message("tool", F.coalesce(o["content"], F.lit(""))))
    own = F.array(own_message(step, reasoning))
    return F.when(step["planner_output"]["action"] == "tool_call", F.concat(own, told)).otherwise(own)


def last_intent(steps: Column, resolve, expected: Column | None = None, default: str | None = None) -> Column:
    """The intent of the last step that has a known one, else the expected one, else ``default``."""
    known = F.filter(F.transform(steps, lambda s: resolve(s["planner_output"]["intent"])), lambda i: i.isNotNull())
    return F.coalesce(F.try_element_at(known, F.lit(-1)), *([resolve(expected)] if expected is not None else []), F.lit(default))


def last_ask(steps: Column) -> Column:
    asks = F.transform(F.filter(steps, lambda s: s["planner_output"]["action"] == "ask_clarification"), lambda s: strip(F.coalesce(s["planner_output"]["ask"], F.lit(""))))
    asks = F.filter(asks, lambda a: a != "")
    return F.try_element_at(asks, F.lit(-1))


def _observations(steps: Column) -> Column:
    return F.flatten(F.transform(steps, lambda s: s["observations"]))


def external_info(steps: Column, most: int = 6000, errors: bool = True) -> Column:
    """Numbered observations with text, joined by blank lines and cut at ``most`` characters.

    An unnamed tool is called after its number; failed calls are marked, or left out without ``errors``.
    """
    failed = lambda o: F.coalesce(o["error"], F.lit(False))
    body = lambda o: strip(F.coalesce(o["content"], F.lit("")))
    kept = F.filter(_observations(steps), lambda o: (body(o) != "") if errors else ((body(o) != "") & ~failed(o)))

    def chunk(o: Column, i: Column) -> Column:
        number = (i + 1).cast("string")
        name = F.coalesce(F.when(o["name"] != "", o["name"]), F.concat(F.lit("tool_"), number))
        return F.concat(F.lit("【"), number, F.lit(". "), name, F.when(failed(o), FAILED).otherwise(""), F.lit("】\n"), body(o))

    text = strip(F.array_join(F.transform(kept, chunk), "\n\n"))
    return truncate(once(text, lambda t: F.when(t != "", t).otherwise(NO_INFO)), most)


def tool_names(steps: Column) -> Column:
    """Names of the tools observed, in order of first sight."""
    return F.array_distinct(F.filter(F.transform(_observations(steps), lambda o: F.coalesce(o["name"], F.lit(""))), lambda n: n != ""))


def has_tool_error(steps: Column) -> Column:
    return F.coalesce(F.exists(_observations(steps), lambda o: F.coalesce(o["error"], F.lit(False))), F.lit(False))


def first_file_plan(steps: Column, plan_tools: list[str], defaults: dict[str, str]) -> Column:
    """The first call of a plan tool with the missing arguments filled in, as JSON text; null without one."""
    calls = F.filter(F.flatten(F.transform(steps, lambda s: s["planner_output"]["tool_calls"])), lambda c: c["name"].isin(*plan_tools))
    call = F.element_at(F.when(F.size(calls) > 0, calls), 1)
    fill = [F.coalesce(F.when(F.get_json_object(call["arguments"], f"$.{k}") != "", F.get_json_object(call["arguments"], f"$.{k}")), F.lit(v)).alias(k) for k, v in defaults.items()]
    return F.when(call.isNotNull(), F.to_json(F.struct(call["name"].alias("tool_name"), *fill)))


def backfill(steps: Column, resolve) -> Column:
    """Steps in which a tool call without text and with no or the catch-all intent takes the last step's intent.

    Nothing changes if the last step's intent is unknown or the catch-all itself. The last step stays.
    """
    final = resolve(F.element_at(steps, -1)["planner_output"]["intent"])
    usable = final.isNotNull() & (final != OTHER_INTENT)

    def patch(s: Column, i: Column) -> Column:
        out = s["planner_output"]
        blank = strip(F.coalesce(s["planner_raw_output"]["raw_content"], F.lit(""))) == ""
        open_ = F.coalesce(resolve(out["intent"]), F.lit(OTHER_INTENT)) == OTHER_INTENT
        fix = usable & (i < F.size(steps) - 1) & (out["action"] == "tool_call") & blank & open_
        return F.when(F.coalesce(fix, F.lit(False)), s.withField("planner_output", out.withField("intent", final))).otherwise(s)

    return F.when(F.size(steps) > 0, F.transform(steps, patch)).otherwise(steps)


def backfilled(before: Column, after: Column) -> Column:
    """Places of the steps that ``backfill`` changed."""
    places = F.transform(F.zip_with(before, after, lambda a, b: ~a["planner_output"]["intent"].eqNullSafe(b["planner_output"]["intent"])), lambda c, i: F.when(c, i))
    return F.coalesce(F.array_compact(places), F.array().cast("array<int>"))


def backfill_count(before: Column, after: Column) -> Column:
    """How many steps ``backfill`` changed."""
    return F.size(backfilled(before, after)).cast("long")
