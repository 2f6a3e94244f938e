"""String expressions: normalisation, n-grams, chat-prompt parsing, dialogue rendering.

Every function maps Columns to a Column, so it stays inside the plan; none is a UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers of a rendered chat prompt.
USER, ASSISTANT, END = "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_end|>"
ANY_ASSISTANT = "<|im_start|>assistant"
# Labels in rendered histories.
USER_LABEL, ASSISTANT_LABEL = "用户：", "助手："
COMPRESSED_TITLE, RECENT_TITLE = "【压缩历史对话】", "【近期历史对话】"
# Sections of a prompt, by any of the strings that show them.
SECTIONS = {
    "has_system": ("<|im_start|>system",),
    "has_user": ("<|im_start|>user",),
    "has_assistant": ("<|im_start|>assistant",),
    "has_tool": ("<|im_start|>tool", "<|im_start|>function"),
    "has_think": ("<think>",),
    "has_tool_schema": ("# Tools", "<tools>"),
}
# Patterns that state an intent, in the order in which they are tried.
INTENT_PATTERNS = (
    r'"intent"\s*:\s*"([^"]+)"',
    r"'intent'\s*:\s*'([^']+)'",
    r"intent\s*[:：]\s*([^\s。；;，,\n]+)",
    r"意图\s*[:：]\s*([^\s。；;，,\n]+)",
)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often and in whatever branches it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space of any script at either end; Spark's own trim takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def or_default(c: Column, default: str | Column = "") -> Column:
    """``c`` unless it is null or empty."""
    return F.coalesce(F.when(c != "", c), F.lit(default) if isinstance(default, str) else default)


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty, else null."""
    return F.coalesce(*(once(c, lambda v: F.when(v != "", v)) for c in columns))


def normalize(c: Column) -> Column:
    """Lower case; only CJK ideographs, ASCII letters and digits stay, so accented letters vanish."""
    return F.regexp_replace(F.lower(c), r"[^一-鿿A-Za-z0-9]", "")


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct character n-grams of the normalised text, none if it is shorter than ``n``.

    A look-ahead match takes every position in one scan.
    """
    return F.array_distinct(F.regexp_extract_all(normalize(F.coalesce(c, F.lit(""))), F.lit(f"(?=(.{{{n}}}))"), 1))


def strip_think(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""))


def tidy_lines(c: Column) -> Column:
    """Ends stripped, and the end of each line; line ends of every kind become line feeds."""
    lines = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"\r\n|[\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]", "\n")
    return strip(F.regexp_replace(lines, r"(?U)[\s&&[^\n]]+(?=\n)", ""))


def split_reasoning(text: Column, reasoning: Column | None = None) -> tuple[Column, Column]:
    """(reasoning, answer): a given reasoning, else all closed think blocks joined by blank lines, else an unclosed one."""
    t = F.coalesce(text, F.lit(""))
    blocks = F.regexp_extract_all(t, F.lit(r"(?s)<think>(.*?)</think>"), 1)
    closed = F.size(blocks) > 0
    joined = F.array_join(F.filter(F.transform(blocks, strip), lambda b: b != ""), "\n\n")
    opened = (F.instr(t, "<think>") > 0) & ~closed
    head, tail = F.substring_index(t, "<think>", 1), F.regexp_extract(t, r"(?s)<think>(.*)$", 1)
    own = F.when(closed, joined).when(opened, strip(tail)).otherwise("")
    given = strip(F.coalesce(reasoning, F.lit(""))) if reasoning is not None else F.lit("")
    return or_default(given, own), F.when(closed, strip_think(t)).when(opened, strip(head)).otherwise(strip(t))


def compose_reasoning(reasoning: Column, content: Column) -> Column:
    """Reasoning in a think block, then the content; either may be blank."""
    def join(r: Column, c: Column) -> Column:
        block = F.concat(F.lit("<think>\n"), r, F.lit("\n</think>"))
        return F.when((r != "") & (c != ""), F.concat(block, F.lit("\n"), c)).when(r != "", block).otherwise(c)

    both = F.struct(strip(F.coalesce(reasoning, F.lit(""))).alias("r"), strip(F.coalesce(content, F.lit(""))).alias("c"))
    return once(both, lambda s: join(s["r"], s["c"]))


def text_length(c: Column) -> Column:
    """Code points, 0 for null."""
    return F.coalesce(F.length(c.cast("string")), F.lit(0)).cast("long")


def occurrences(c: Column, part: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("long")


def last_turn(prompt: Column, marker: str) -> Column:
    """What stands between the last ``marker`` and the next end mark, stripped; '' without the marker."""
    after = F.substring_index(prompt, marker, -1)
    return F.when(F.contains(prompt, F.lit(marker)), strip(F.substring_index(after, END, 1))).otherwise("")


def from_last_assistant(prompt: Column) -> Column:
    """From the last assistant mark on, or the whole prompt without one; the mark itself is left out."""
    return F.substring_index(prompt, ANY_ASSISTANT, -1)


def section_flags(prompt: Column) -> dict[str, Column]:
    found = {}
    for name, marks in SECTIONS.items():
        tests = [F.contains(prompt, F.lit(m)) for m in marks]
        found[name] = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return found


def infer_action(prompt: Column) -> Column:
    """The action stated in the last assistant block, by priority; ``unknown`` if none is."""
    block, found = from_last_assistant(prompt), F.lit("unknown")
    for action in ("ask_clarification", "planning_finish", "tool_call"):
        states = F.contains(block, F.lit(f'"action": "{action}"')) | F.contains(block, F.lit(f'"action":"{action}"'))
        found = F.when(states, action).otherwise(found)
    return found


def infer_intent(prompt: Column, intents: list[str]) -> Column:
    """The first pattern in the last assistant block whose capture, freed of quotes, is a known intent."""
    block = F.substring_index(from_last_assistant(prompt), END, 1)

    def read(pattern: str) -> Column:
        raw = strip(F.regexp_replace(strip(F.regexp_extract(block, pattern, 1)), "^[\"“”]+|[\"“”]+$", ""))
        name = F.regexp_replace(raw, "[。.;；,，]+$", "")
        return F.when(name.isin(intents), name)

    return F.coalesce(*(read(p) for p in INTENT_PATTERNS), F.lit("(missing)"))


def truncate(c: Column, most: int, mark: str = "……") -> Column:
    return once(c, lambda t: F.when((F.length(t) > most) & F.lit(most > 0), F.concat(rstrip(F.left(t, F.lit(most))), F.lit(mark))).otherwise(t))


def safe_path_part(c: Column, default: str = "default") -> Column:
    """Anything but letters, digits, underscores, dots and dashes becomes an underscore; none of the last three at the ends."""
    clean = F.regexp_replace(or_default(strip(F.coalesce(c, F.lit(""))), default), r"[^\p{L}\p{N}_.-]", "_")
    return or_default(F.regexp_replace(clean, r"^[._-]+|[._-]+$", ""), default)


def dialogue_line(user: Column, assistant: Column, keep_think: bool = False) -> Column:
    """Array of the one or two labelled lines of a turn."""
    u = tidy_lines(user)
    a = strip(F.coalesce(assistant, F.lit(""))) if keep_think else strip_think(tidy_lines(assistant))
    lines = F.array(F.when(u != "", F.concat(F.lit(USER_LABEL), u)), F.when(a != "", F.concat(F.lit(ASSISTANT_LABEL), a)))
    return F.array_compact(lines)


def render_dialogue(turns: Column, keep_think: bool = False) -> Column:
    """``turns`` array<struct<user,assistant>> as text, a line for each side of a turn."""
    return F.array_join(F.flatten(F.transform(turns, lambda t: dialogue_line(t["user"], t["assistant"], keep_think))), "\n")


def history_context(compressed: Column, recent: Column) -> Column:
    c, r = tidy_lines(compressed), tidy_lines(recent)
    return F.concat_ws(
        "\n\n",
        F.when(c != "", F.concat(F.lit(COMPRESSED_TITLE + "\n"), c)),
        F.when(r != "", F.concat(F.lit(RECENT_TITLE + "\n"), r)),
    )


def chatml(messages: Column) -> Column:
    """``messages`` array<struct<role,content>> in plain ChatML. A model's own template is not part of this engine."""
    one = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(END + "\n"))
    return F.array_join(F.transform(messages, one), "")


def markdown_cell(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), r"[\r\n]+", "<br>")


def meter(share: Column, width: int = 20) -> Column:
    full = F.least(F.greatest(F.floor(share * width / 100 + 0.5), F.lit(0)), F.lit(width)).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))
