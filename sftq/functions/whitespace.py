"""Unicode whitespace and line breaks, as Python's ``str`` methods see them.

Spark's ``trim`` removes only the space character and Java's ``\\s`` is ASCII, so
the wider sets are spelled out once here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() holds.
WHITESPACE = "".join(
    chr(point)
    for first, last in [
        (0x09, 0x0D),
        (0x1C, 0x20),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for point in range(first, last + 1)
)

# Java character classes for the same set, and for str.splitlines().
_SPACES = r"\s\x1c-\x1f\x85\p{Z}"
NOT_BREAK = r"\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029"

SPACE = f"[{_SPACES}]"
SAME_LINE = rf"[{_SPACES}&&[^\n]]"
BLANK = rf"[{_SPACES}&&[^{NOT_BREAK}]]"
LINE_BREAK = rf"\r\n|[{NOT_BREAK}]"
LINE_END = f"(?![^{NOT_BREAK}])"


def unix_lines(text: Column) -> Column:
    """Every line break as ``\\n``, so that ``(?md)^`` finds each line's start (no lookbehind)."""
    return F.regexp_replace(text, LINE_BREAK, "\n")


def strip(text: Column) -> Column:
    """``str.strip()``: linear, no regex."""
    return F.btrim(text, F.lit(WHITESPACE))
