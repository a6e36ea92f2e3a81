"""Reading stored pages: lines, tokens, and whether a page was printed to a width.

Whether a page is *printed* (its lines end where the paper ended) or *flowing* (they end where a
paragraph does) is judged by boosted trees on how the page's pairs of neighbouring lines look. The trees
are fitted at run time on pages of the corpus itself, laid out anew: a sampled page's text wrapped at a
random width is a printed page, its paragraphs or sentences one to a line are a flowing one. No line
length decides alone. ``SAMPLE_PAGES`` bounds the sample.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np

from lexigraft.llm.boosting import BoostedTrees

SAMPLE_PAGES = 600
LETTER = r"A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0370-\u03ff\u1e00-\u1fff"  # Latin and Greek
MARKS = "-\u2010\u2011\u00ac\u00ad"
BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
WORD_AT = re.compile(f"[{LETTER}0-9!|]+")
COMPOUND = re.compile(f"[{LETTER}0-9]+(?:[-\u2010\u2011][{LETTER}0-9]+)*")
TOKEN = re.compile(f"[0-9!|]*[{LETTER}][{LETTER}0-9!|]*")
_TAIL = re.compile(f"[{LETTER}0-9!|]+$")
HEAD = re.compile(f"[{LETTER}]+")
_FIRST = re.compile("[^\\s\u2e80-\uffff]+|.", re.S)
_STOP = frozenset(".!?。！？；:：")
_PIECE = re.compile("[^\\s\u2e80-\uffff]+|[\u2e80-\uffff]|\\s+")
_SENTENCE = re.compile("(?<=[.!?。！？；])\\s*")


def is_letter(ch: str) -> bool:
    return HEAD.match(ch) is not None


def is_wide(ch: str) -> bool:
    """Signs that are written without blanks between words."""
    return "\u3400" <= ch <= "\u9fff" or "\u30a1" <= ch <= "\u30ff"


def lines_of(text: str) -> list[str]:
    """The lines of a page that show something, without the blanks around them."""
    return [x for x in rows_of(text) if x]


def rows_of(text: str) -> list[str]:
    """All lines of a page without the blanks around them."""
    return [line.strip(BLANKS) for line in text.split("\n")]


def page_features(text: str, raw: list[str] | None = None) -> list[float] | None:
    """Features of the page's layout from its line pairs (``raw``: its ``rows_of``); None for a page that shows nothing."""
    raw = rows_of(text) if raw is None else raw
    lens = sorted(len(x) for x in raw if x)
    n = len(lens)
    if not n:
        return None
    width = lens[int(0.9 * (n - 1))]
    pairs = forced = stops = full = 0
    for a, b in zip(raw, raw[1:]):
        if a and b:
            pairs += 1
            la = len(a)
            first = _FIRST.match(b).end()
            forced += la + first + (first > 1) > width
            stops += a[-1] in _STOP
            full += la > 0.7 * width
    some = pairs or 1
    return [math.log(width), math.log(lens[-1]), math.log(n), forced / some if pairs else -1.0, math.log1p(pairs), stops / some if pairs else -1.0, full / some if pairs else -1.0, len(text.encode("utf-8", "replace")) / len(text)]


def flat(lines: list[str]) -> str:
    out = ""
    for x in lines:
        out += x if not out or ord(out[-1]) > 0x2E7F or ord(x[0]) > 0x2E7F else " " + x
    return out


def wrap(text: str, width: int) -> list[str]:
    """The text in lines of at most ``width`` signs, broken between words or wide signs."""
    out, line = [], ""
    for p in _PIECE.findall(text):
        if line and len(line) + len(p) > width:
            out.append(line.strip())
            line = ""
        line += " " if p.isspace() else p
    return [x for x in [*out, line.strip()] if x]


def _layouts(text: str, r: random.Random) -> list[tuple[str, float]]:
    """The text as a printed and as a flowing page, a list of clauses among them."""
    parts = [s for s in _SENTENCE.split(flat(lines_of(text))) if s]
    if not parts:
        return []
    paragraphs, at = [], 0
    while at < len(parts):
        k = r.randint(1, 6)
        paragraphs.append(flat(parts[at : at + k]))
        at += k
    gap = "\n\n" if r.random() < 0.6 else "\n"
    wide = sum(map(is_wide, paragraphs[0])) * 2 > len(paragraphs[0])
    width = r.randint(12, 80) if wide else r.randint(28, 160)
    printed = gap.join("\n".join(wrap(p, width)) for p in paragraphs)
    rows = printed.split("\n")
    most = r.randint(2, 40)
    start = r.randint(0, max(0, len(rows) - most))
    listed = [c for p in parts for c in re.split("[,;，；、]", p) if c.strip()]
    out = [("\n".join(rows[start : start + most]), 1.0), (gap.join(paragraphs), 0.0), (gap.join(paragraphs[: r.randint(1, 3)]), 0.0)]
    out.append(("\n".join(r.choice((parts, listed))[: r.randint(2, 60)]), 0.0))
    if r.random() < 0.5:
        items = [w for w in _PIECE.findall(text) if not w.isspace()][: r.randint(4, 40)]
        out.append(("\n".join(items), 0.0))
        out.append(("\n".join([*r.sample(listed, min(len(listed), r.randint(1, 6))), paragraphs[0]]), 0.0))
    return out


def fit_layout(texts: list[str]) -> BoostedTrees:
    """Trees that tell printed pages from flowing ones."""
    x, y = [], []
    for k, t in enumerate(texts):
        for page, label in _layouts(t[:4000], random.Random(f"{k}:{len(t)}")):
            f = page_features(page)
            if f:
                x.append(f)
                y.append(label)
    return BoostedTrees(rounds=40, depth=4).fit(np.array(x, float).reshape(len(x), 8), np.array(y, float))


# -- page numbers --------------------------------------------------------------------------------

_ROMAN = re.compile("(c{0,4})(xc|xl|l?x{0,4})(ix|iv|v?i{0,4})$")
_R = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_DECOR = " []\t(){}<>\u00b7\u2022.\u2013\u2014_~*=|-\u3000\xa0"
#: fixed values: what stands beside a page's number
_NUMBERED = re.compile("(?:page|p\\.?|seite|pagina|página) ?(\\d{1,9})(?: ?(?:of|/|von|de) ?\\d{1,9})?|(\\d{1,9})(?: ?/ ?\\d{1,9})?|第 ?(\\d{1,9}) ?页(?:[ ,，]*共 ?\\d{1,9} ?页)?")


_MAYBE = re.compile("\\d|^[\\W_]*[ivxlcIVXLC]+[\\W_]*$")


def roman(s: str) -> int | None:
    if not s or not _ROMAN.match(s):
        return None
    v = [_R[c] for c in s]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0]))


def page_value(line: str) -> int | None:
    """The number a line consists of, decoration aside; None for any other line."""
    if len(line) > 60 or not _MAYBE.search(line):
        return None
    s = re.sub("\\s+", " ", line.lower()).strip(_DECOR)
    m = _NUMBERED.fullmatch(s)
    if m:
        return int(m[1] or m[2] or m[3])
    return roman(s)


# -- breaks --------------------------------------------------------------------------------------


def ends_broken(line: str) -> bool:
    """A letter and a mark at the end."""
    return len(line) > 1 and line[-1] in MARKS and is_letter(line[-2])


def runs_on(line: str, nxt: str) -> bool:
    """A Latin word may go on over the end of a line of wide text, where there is no mark."""
    return not line.isascii() and nxt != "" and is_letter(line[-1]) and is_letter(nxt[0]) and any(map(is_wide, line))


def unbroken(body: list[str]) -> tuple[list[str], list[str]]:
    """Lines without the words broken at their ends, and those words joined."""
    out, joined, prev = [], [], ""
    for i, line in enumerate(body):
        nxt = body[i + 1] if i + 1 < len(body) else ""
        x = line
        if line[-1] in MARKS and ends_broken(line):
            x = _TAIL.sub("", line[:-1])
            m = HEAD.match(nxt)
            if m:
                joined.append(line[len(x) : -1] + m[0])
        elif nxt and runs_on(line, nxt):
            x = _TAIL.sub("", line)
        if prev and (prev[-1] in MARKS and ends_broken(prev) or runs_on(prev, line)):
            m = WORD_AT.match(x)
            x = x[m.end() :] if m else x
        out.append(x)
        prev = line
    return out, joined


def broken_ends(body: list[str]) -> list[tuple[int, str, str, str, bool]]:
    """(no, left, mark, right, over) of every line that ends in a letter and a mark."""
    out = []
    for i, line in enumerate(body):
        if line[-1] in MARKS and ends_broken(line):
            left = re.search(f"[{LETTER}0-9]+$", line[:-1])
            nxt = body[i + 1] if i + 1 < len(body) else ""
            out.append((i, left[0].lower() if left else "", line[-1], head_of(nxt), i == len(body) - 1))
    return out


def head_of(line: str) -> str:
    m = re.match(f"[{LETTER}0-9]+", line)
    return m[0].lower() if m else ""
