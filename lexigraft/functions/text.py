"""Text scalars shared by operators, as Column expressions.

``WS`` is the white-space class of Unicode's ``isspace`` (29 code points, fixed values), spelt out
because Java's ``\\s`` is ASCII only; RE2 accepts the same spelling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
#: the same code points as they are
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns that are computed once a row: later filters and uses can not pull them apart."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def strip_ws(c: Column) -> Column:
    """Both ends without white space of any kind; null stays null."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(~c.rlike(f"(?s)[^{WS[1:-1]}]"), F.lit(True))
