"""Text expressions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space when text is stripped or split (29 of them).
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Null counts as empty."""
    return F.coalesce(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"\A[{WS}]+|[{WS}]+\z", "")


def lowered(c: Column | str) -> Column:
    return F.lower(strip(text(c)))


def tokens(c: Column | str) -> Column:
    """The set of lower-case tokens between white space."""
    return F.array_distinct(F.filter(F.split(F.lower(text(c)), f"[{WS}]+"), lambda x: x != ""))


def task_tokens(c: Column | str) -> Column:
    return F.filter(F.split(text(c), rf"[,;/{WS}]+"), lambda x: x != "")


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9_]+"), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; an empty one is similar to nothing."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def pattern(family: list[str]) -> str:
    return rf"(?iUd)\b(?:{'|'.join(family)})\b"


def hits(c: Column, family: list[str]) -> Column:
    return F.regexp_count(c, F.lit(pattern(family)))


def has(c: Column, family: list[str]) -> Column:
    return c.rlike(pattern(family))


def any_in(c: Column, cues: list[str]) -> Column:
    """Whether any of the substrings occurs; substrings, not words."""
    out = F.lit(False)
    for cue in cues:
        out = out | c.contains(cue)
    return out


def joined(*parts: Column) -> Column:
    """Non-empty parts, by single spaces."""
    return F.concat_ws(" ", *(F.when(text(p) != "", p) for p in parts))


def excerpt(c: Column | str, head: int = 1400, tail: int = 400) -> Column:
    s = strip(text(c))
    return F.when(F.length(s) <= head + tail, s).otherwise(F.concat(F.substring(s, 1, head), F.lit("\n...\n"), F.substring(s, -tail, tail)))


def truncate(c: Column | str, most: int = 500, suffix: str = "...") -> Column:
    s = text(c)
    return F.when(F.length(s) <= most, s).otherwise(F.concat(F.substring(s, 1, most - len(suffix)), F.lit(suffix)))


def code_blocks(c: Column | str, language: str | None = None) -> Column:
    """Bodies of fenced blocks, of one language or of any."""
    opening = language if language else r"(?:\w+)?"
    return F.regexp_extract_all(text(c), F.lit(rf"(?s)```{opening}\s*(.*?)\s*```"), F.lit(1))


def module_code(c: Column | str) -> Column:
    """Fenced Verilog joined by blank lines, else every module in the text, else empty."""
    fenced = F.transform(F.regexp_extract_all(text(c), F.lit("(?s)```verilog(.*?)```"), F.lit(1)), strip)
    ports = r"\([^)]*\)"
    modules = F.regexp_extract_all(text(c), F.lit(rf"(?s)module\s+\w+(?:\s*#\s*{ports})?\s*{ports}\s*;.*?endmodule"), F.lit(0))
    return F.array_join(F.when(F.size(fenced) > 0, fenced).otherwise(modules), "\n\n")


def unfence(c: Column | str) -> Column:
    s = strip(text(c))
    inner = F.regexp_extract(s, r"(?s)\A```json[^\n]*\n(.*)\n```", 1)
    return F.when(s.startswith("```json") & (inner != ""), inner).otherwise(s)


def safe_double(c: Column | str) -> Column:
    return F.nullif(strip(col(c).cast("string")), F.lit("")).try_cast("double")


def string_list(items: Column, extra: Column | None = None) -> Column:
    """Stripped, without empty ones, each once in order of first appearance."""
    every = F.coalesce(items, F.array().cast("array<string>"))
    if extra is not None:
        every = F.concat(every, F.array(extra))
    return F.array_distinct(F.filter(F.transform(F.filter(every, lambda x: x.isNotNull()), strip), lambda x: x != ""))
