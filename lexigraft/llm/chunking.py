"""Cutting oversized texts at natural boundaries, with overlap.

One bounded-quantifier regular expression consumes the text: its alternatives are ordered by
boundary strength (blank line, line break, sentence end, clause end, blank) and each takes as much
as the limit allows; the last alternative takes characters. A lookback group of bounded length
supplies the overlap with the piece before. Pieces come out of ``regexp_extract_all`` inside the
JVM; every quantified atom is a single character class, so matching is linear and not recursive,
whatever the length of the text.

Defined results
* texts at or under the limit, null and empty texts give no pieces here (``keep_short`` passes the
  non-null ones through as piece 0);
* pieces are at most ``limit`` code points, numbered from 0; cores (pieces without their overlap)
  concatenate to the text exactly;
* each piece after the first repeats about ``overlap`` code points (5 fewer to 20 more) of the text before its core,
  starting after a blank or mark of punctuation where there is one in that range;
* repeated rows of one (key, text) count once; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLOSERS = "\"'”’」』）)\\]"
_SPACE = r"[\t \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
#: any code point; one beyond the first plane must stand there as itself, or lookback counts its halves
_ANY = r"[\x{0}-\x{10ffff}" + "\U0001f600]"


def boundary_pattern(limit: int, overlap: int) -> str:
    """The core pattern: group 1 or 2 is the lookback, the match itself the core."""
    if not 0 <= overlap < limit or limit - overlap - 20 < 8:
        raise ValueError("overlap must leave room for a core")
    slack = min(20, overlap)
    most = limit - overlap - slack
    least = most // 2
    ends = [
        r"\n{_S}*\n\s?",
        r"\n",
        f"[.!?…][{_CLOSERS}]?" + "{_S}",
        f"[。！？；][{_CLOSERS}]?",
        r"[,;:，、：]{_S}?",
        "{_S}",
    ]
    widest = [4, 1, 3, 2, 2, 1]
    alts = []
    for e, w in zip(ends, widest):
        e = e.replace("{_S}*", _SPACE + "{0,1}").replace("{_S}", _SPACE)
        alts.append(f"{_ANY}{{{least},{most - w}}}{e}")
    whole = f"{_ANY}{{1,{most}}}\\z"
    core = "|".join([whole, *alts, f"{_ANY}{{1,{most}}}"])
    if not overlap:
        return f"()()(?:{core})"
    near = rf"(?<=[\s\p{{Punct}}，。；：、！？]({_ANY}{{{overlap - slack // 4},{overlap + slack}}}))"
    exact = rf"(?<=({_ANY}{{{overlap}}}))"
    return f"(?:\\A|{near}|{exact}|)(?:{core})"


def _pieces(text: Column, limit: int, overlap: int) -> Column:
    p = F.lit(boundary_pattern(limit, overlap))
    back = F.zip_with(F.regexp_extract_all(text, p, F.lit(1)), F.regexp_extract_all(text, p, F.lit(2)), lambda a, b: F.concat(a, b))
    return F.zip_with(back, F.regexp_extract_all(text, p, F.lit(0)), lambda b, c: F.struct(b.alias("overlap"), c.alias("core")))


def split_oversized(df: DataFrame, key: str, text: str, limit: int = 1000, overlap: int = 100, keep_short: bool = False) -> DataFrame:
    """(key, chunk_index, overlap_chars, core, piece) of every text over the limit.

    The only shuffle merges repeated rows, after the length filter, so short texts never move.
    """
    rows = df.select(F.col(f"`{key}`").alias("__k"), F.col(f"`{text}`").alias("__t"))
    rows = rows.where(F.col("__t").isNotNull() if keep_short else F.length("__t") > limit).distinct()
    parts = _pieces(F.col("__t"), limit, overlap)
    if keep_short:
        one = F.array(F.struct(F.lit("").alias("overlap"), F.col("__t").alias("core")))
        parts = F.when(F.length("__t") > limit, parts).otherwise(one)
    out = rows.select("__k", F.posexplode(parts).alias("chunk_index", "p"))
    return out.select(
        F.col("__k").alias(key),
        "chunk_index",
        F.length("p.overlap").alias("overlap_chars"),
        F.col("p.core").alias("core"),
        F.concat("p.overlap", "p.core").alias("piece"),
    )
