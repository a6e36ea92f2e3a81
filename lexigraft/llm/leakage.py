"""Evaluation passages inside training text.

A generalised suffix automaton of the normalised test items is built once; documents are streamed
through it token by token, tracking the longest match that ends at each token. A state knows the
items its substrings occur in, so the moment a match reaches the length limit, its items are known.
The automaton is linear in the items' tokens, not in the corpus. Items are a stated, small set:
their size is checked against ``max_item_tokens`` before the automaton is broadcast; a larger set is
cut into blocks, each streamed over the corpus in its own pass.

Normal form: JSON escapes undone, compatibility composition, case folded; words are runs of letters
and digits, every Han character is a word of its own. Case, punctuation, blanks, line breaks, width,
quote style and escapes therefore do not matter.

Defined results: null, empty and blank texts match nothing; an item shorter than the limit can not
leak; equal items each leak; a document with several passages of an item counts once.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lexigraft.functions.workers import per_worker
from lexigraft.llm.arrow import map_rows

_HAN = "㐀-䶿一-鿿豈-﫿\U00020000-\U0003134f"
_TOKENS = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")
_ESCAPE = re.compile(r"\\+(?:u([0-9a-fA-F]{4})|([nrtbf]))")


def _undo(m: re.Match) -> str:
    return chr(int(m[1], 16)) if m[1] else " "


def normal_tokens(text: str) -> list[str]:
    """The tokens matches are counted in."""
    if "\\" in text:
        text = _ESCAPE.sub(_undo, text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = "".join(c for c in text if unicodedata.category(c) != "Cf") if "­" in text or "​" in text else text
    return _TOKENS.findall(text.casefold())


class SuffixAutomaton:
    """Generalised suffix automaton over token ids with the set of items per state."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[set[int]] = [set()]

    def _new(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.items.append(set())
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = self._new(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = self._new(length[p] + 1, dict(nxt[q]), link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def build(self, items: list[tuple[int, list[int]]]) -> "SuffixAutomaton":
        for _, toks in items:
            last = 0
            for c in toks:
                last = self._extend(last, c)
        for item, toks in items:
            s = 0
            for c in toks:
                s = self.next[s][c]
                t = s
                while t > 0 and item not in self.items[t]:
                    self.items[t].add(item)
                    t = self.link[t]
        return self


def placed_tokens(text: str) -> list[tuple[str, int, int]]:
    """``normal_tokens`` with the places of each token's first and last sign in the text as stored."""
    out, at = [], []
    for m in _PIECES.finditer(text):
        e = _ESCAPE.fullmatch(m[0])
        x = _undo(e) if e else m[0]
        x = unicodedata.normalize("NFKC", x)
        x = "".join(c for c in x if unicodedata.category(c) != "Cf").casefold()
        out.append(x)
        at.extend([m.span()] * len(x))
    return [(m[0], at[m.start()][0], at[m.end() - 1][1]) for m in _TOKENS.finditer("".join(out))]


#: an escape, or a sign with the marks that belong to it
_PIECES = re.compile(r"\\+(?:u[0-9a-fA-F]{4}|[nrtbf])|.[\u0300-\u036f\u3099\u309a]*", re.S)


class ItemIndex:
    """Automaton, token ids and the limits of each item: words in a row, or a share of the item."""

    def __init__(self, items: list[tuple[int, str, str]], words: int, han: int, coverage: float = 2.0):
        self.ids: dict[str, int] = {}
        toks = []
        self.limit: dict[int, int] = {}
        for item, lang, text in items:
            t = normal_tokens(text or "")
            most = han if (lang or "").startswith("zh") else words
            self.limit[item] = min(most, max(1, -int(-coverage * len(t) // 1))) if coverage <= 1 else most
            toks.append((item, [self.ids.setdefault(w, len(self.ids)) for w in t]))
        self.least = min(self.limit.values(), default=1)
        self.auto = SuffixAutomaton().build(toks)

    def matches(self, tokens) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of the longest match that ends at each token, where it is long enough for some item."""
        auto, get, least = self.auto, self.ids.get, self.least
        nxt, link, length = auto.next, auto.link, auto.length
        s = n = 0
        for at, w in enumerate(tokens):
            c = get(w)
            if c is None:
                s = n = 0
                continue
            t = nxt[s].get(c)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = nxt[s].get(c)
            if t is None:
                continue
            s, n = t, n + 1
            if n >= least:
                yield at, n, s

    def over(self, n: int, state: int) -> Iterator[tuple[int, int]]:
        """(item, tokens) of the items a match of ``n`` tokens at ``state`` is too long for."""
        auto = self.auto
        while n >= self.least:
            for i in auto.items[state]:
                if n >= self.limit[i]:
                    yield i, n
            state = auto.link[state]
            n = auto.length[state]

    def leaks(self, text: str) -> set[int]:
        """Items with a passage over their limit in the text."""
        found: set[int] = set()
        done: set[int] = set()
        for _, n, s in self.matches(normal_tokens(text)):
            if s not in done:  # a longer match at the same state has the same items
                found.update(i for i, _ in self.over(n, s))
                if n >= self.auto.length[s]:
                    done.add(s)
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, list[int]]]:
        """(start, end, tokens, items) of the passages over their limits, as places in the stored text; they do not overlap."""
        tokens = placed_tokens(text)
        out: list[list] = []
        for at, n, s in self.matches(t[0] for t in tokens):
            hit = list(self.over(n, s))
            if hit:
                first = at - max(k for _, k in hit) + 1
                items = {i for i, _ in hit}
                while out and first <= out[-1][1] + 1:
                    last = out.pop()
                    first = min(first, last[0])
                    items |= last[2]
                out.append([first, at, items])
        return [(tokens[a][1], tokens[b][2], b - a + 1, sorted(items)) for a, b, items in out]


def _index(shared) -> ItemIndex:
    """The automaton of a block, built once by each worker."""
    return per_worker("items", shared.value[0], lambda: ItemIndex(*shared.value[1:]))


def _leaks_udf(shared):
    @F.pandas_udf("array<bigint>")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _index(shared)
        for s in batches:
            yield pd.Series([sorted(index.leaks(t)) if t else [] for t in s], dtype=object)

    return leaks


_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("items", pa.list_(pa.int64()))])


def item_blocks(items: DataFrame, item_id: str, item_text: str, lang: str, most: int) -> Iterator[list[tuple[int, str, str]]]:
    """The stated item set in blocks of at most ``most`` signs (or one item): the driver holds one block at a time."""
    rows = items.select(F.col(f"`{item_id}`").cast("bigint").alias("i"), F.col(f"`{lang}`").alias("l"), F.col(f"`{item_text}`").alias("t")).where("t is not null and i is not null")
    block: list[tuple[int, str, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        if block and size + len(r.t) > most:
            yield block
            block, size = [], 0
        block.append((r.i, r.l, r.t))
        size += len(r.t)
    if block:
        yield block


def _by_block(docs: DataFrame, items: DataFrame, make, ids: tuple[str, str, str, str, str], limits: tuple, max_item_tokens: int) -> DataFrame | None:
    doc_id, text, item_id, item_text, lang = ids
    d = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text <> ''")
    out = None
    for block in item_blocks(items, item_id, item_text, lang, max_item_tokens):
        one = make(d, docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block, *limits)))
        out = one if out is None else out.unionByName(one)
    return out


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", lang: str = "lang",
    words: int = 15, han: int = 35, max_item_tokens: int = 2_000_000,
) -> DataFrame:
    """(doc_id, item_id) of every document that holds a passage of an item."""
    make = lambda d, shared: d.select("doc_id", F.explode(_leaks_udf(shared)("text")).alias("item_id"))
    out = _by_block(docs, items, make, (doc_id, text, item_id, item_text, lang), (words, han), max_item_tokens)
    return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint") if out is None else out.distinct()


def leaked_spans(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", lang: str = "lang",
    words: int = 15, han: int = 35, coverage: float = 0.8, max_item_tokens: int = 2_000_000,
) -> DataFrame:
    """(doc_id, start, end, words, items): the passages over the length limit, or over ``coverage`` of an item, as
    places of the stored text from 0, ``end`` behind the last sign."""

    def make(d: DataFrame, shared) -> DataFrame:
        def rows(doc: list[int], texts: list[str]) -> Iterator[tuple]:
            index = _index(shared)
            return ((i, *span) for i, t in zip(doc, texts) for span in index.spans(t))

        return map_rows(d, rows, _SPANS)

    out = _by_block(docs, items, make, (doc_id, text, item_id, item_text, lang), (words, han, coverage), max_item_tokens)
    return docs.sparkSession.createDataFrame([], from_arrow_schema(_SPANS)) if out is None else out.distinct()


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, ss in zip(text, spans):
        at, kept = 0, []
        for a, b in sorted((x["start"], x["end"]) for x in ss):
            kept.append(t[at : max(a, at)])
            at = max(at, b)
        out.append("".join([*kept, t[at:]]))
    return pd.Series(out, dtype=object)


def cleaned(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """(doc_id, text, removed): the affected documents without their leaked passages, and how many were taken out."""
    spans = leaked_spans(docs, items, doc_id, text, **limits).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("s"), F.count("*").alias("removed"))
    d = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return d.join(spans, "doc_id").select("doc_id", _without("text", "s").alias("text"), "removed")
