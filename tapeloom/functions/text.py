"""Text and time functions as Columns; they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNICODE = "(?iuU)"


def hms(us: Column) -> Column:
    """HH:MM:SS of microseconds, cut to whole seconds, without wrapping at 24 hours."""
    s = F.floor(us / 1_000_000.0).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long"), F.pmod(s, F.lit(60)))


def seconds_of(ts: Column) -> Column:
    p = F.split(ts, ":")
    return (p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int")).cast("long")


def tokens(text: Column) -> Column:
    """Words between white space; none for blank text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(tokens(text)), F.lit(0)).cast("long")


def hit(text: Column, pattern: str) -> Column:
    return text.rlike(UNICODE + pattern)


def any_hit(text: Column, patterns: list[str]) -> Column:
    return text.rlike(UNICODE + "|".join(f"(?:{p})" for p in patterns))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def re2(pattern: str) -> str:
    """The pattern for an engine whose word borders and classes are ASCII only and which cannot look around."""
    w = r"[\p{L}\p{N}_]"
    out = pattern.replace(r"[^\w\s]", r"[^\p{L}\p{N}_\s]").replace(r"\w", w)
    parts, res = out.split(r"\b"), ""
    for i, p in enumerate(parts):
        res += p
        if i < len(parts) - 1:
            opening = p == "" and i == 0 or p.endswith(("(", "|", "(?:")) or (i + 1 < len(parts) and i % 2 == 0)
            res += r"(?:^|[^\p{L}\p{N}_])" if opening else r"(?:$|[^\p{L}\p{N}_])"
    return res


def sql_any(column: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, '(?i){re2(p)}')" for p in patterns).replace("''", "'") + ")"
