"""Regular expressions with ECMAScript meaning on Java's engine, and text helpers that depend on them.

Differences bridged: white space includes no-break and other Unicode spaces, word boundaries are ASCII, case-insensitive
matching covers Cyrillic, and ``$`` is the very end of the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
#: One of them; none lies from U+0100 to U+167F, so Cyrillic letters are turned away by the first test.
_SPACE = rf"[[^\u0100-\u167F]&&[{SPACES}]]"
_WORD = "[A-Za-z0-9_]"
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def rx(pattern: str, flags: str = "iu") -> str:
    """Java pattern with the meaning that ``pattern`` has in ECMAScript."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            pair = pattern[i : i + 2]
            out.append({"\\s": SPACES if in_class else _SPACE, "\\b": _BOUNDARY}.get(pair, pair))
            i += 2
            continue
        if c == "[" and not in_class:
            in_class = True
        elif c == "]":
            in_class = False
        out.append(r"\z" if c == "$" and not in_class else c)
        i += 1
    return (f"(?{flags})" if flags else "") + "".join(out)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it (a column that is named twice is worked out twice)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(c: Column, pattern: str, flags: str = "iu") -> Column:
    """Whether the pattern occurs; null is no."""
    return F.coalesce(F.rlike(c, F.lit(rx(pattern, flags))), F.lit(False))


def capture(c: Column, pattern: str, group: int = 1, flags: str = "iu") -> Column:
    """A group of the first match, null without a match (or where the group is empty)."""
    return F.nullif(F.regexp_extract(c, rx(pattern, flags), group), F.lit(""))


def swap(c: Column, pattern: str, by: str, flags: str = "iu") -> Column:
    """Replace every match."""
    return F.regexp_replace(c, rx(pattern, flags), by)


def trim(c: Column) -> Column:
    return swap(c, r"^\s+|\s+$", "", "")


def normal_spaces(c: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(swap(c, r"\s+", " ", ""))


def text_or_null(c: Column) -> Column:
    """Normalised text, null if nothing is left."""
    return let(normal_spaces(c), lambda t: F.when(F.length(t) > 0, t))


def first(a: Column, test) -> Column:
    """First element that passes, or null."""
    return F.get(F.filter(a, test), F.lit(0))


def index_of(a: Column, test) -> Column:
    """0-based index of the first element that passes, or null."""
    return F.get(F.filter(F.transform(a, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull()), F.lit(0))
