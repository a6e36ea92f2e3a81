"""What a scanner makes of letters, learned from the corpus.

Words that only printed pages hold are set beside words of flowing pages that differ in one place: the two
spellings of that place are an *edit* (what was meant, what stands there). Edits a scanner makes come up
again and again; edits that part different words come up among the words of flowing pages too. The log
odds of the two tell how far an edit is to be believed. Wide signs are learned the same way from windows of
a sign between its neighbours. Nothing here is listed by hand. ``MOST_EDITS`` bounds what reaches the driver:
edits by number of words, most first; rarer edits count as unknown ones, they drop no word.
"""

from __future__ import annotations

import difflib
import math
import random
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigraft.llm.arrow import map_rows

GAP = 2
MOST_EDITS = 400
_M, _B = (1 << 61) - 1, 1_000_003


def gap_keys(word: str, most: int = GAP) -> list[int]:
    """Keys of the word with up to ``most`` neighbouring letters left out at each place.

    Two words that differ in one place by at most ``most`` letters on either side share a key. Keys are
    rolling hashes of what stands before and behind the gap, so long words stay linear.
    """
    n = len(word)
    pre, suf = [0] * (n + 1), [0] * (n + 1)
    for i, ch in enumerate(word):
        pre[i + 1] = (pre[i] * _B + ord(ch)) % _M
    for i in range(n - 1, -1, -1):
        suf[i] = (suf[i + 1] * _B + ord(word[i]) + 7) % _M
    return list({(pre[i] * 31 + suf[i + k] * 17 + i * 0x9E3779B97F4A7C15) % _M for k in range(most + 1) for i in range(n - k + 1) if n - k > 0})


_KEYS = pa.schema([("id", pa.int64()), ("k", pa.int64())])


def _key_rows(ids: list[int], words: list[str]) -> Iterator[tuple[int, int]]:
    return ((i, k) for i, w in zip(ids, words) for k in gap_keys(w))


def gapped_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(w, c): words ``left.w`` and ``right.w`` that differ in one place, by an inverted join on gapped q-grams.

    A key fixes all letters but two, so its posting list is bounded by the alphabet and no key is hot. Words
    pass the join as numbers, so a long word costs no more than its letters; a word that is longer than all
    of ``right`` by more than the gap has no partner and is left out.
    """
    longest = right.agg(F.max(F.length("w")).alias("n")).first().n or 0
    left = left.where(F.length("w") <= longest + GAP)
    a, b = (d.select(F.xxhash64("w").alias("id"), "w").distinct() for d in (left, right))
    p = map_rows(a, _key_rows, _KEYS).join(map_rows(b, _key_rows, _KEYS).withColumnRenamed("id", "id2"), "k").where("id <> id2").select("id", "id2").distinct()
    return p.join(a, "id").join(b.select(F.col("id").alias("id2"), F.col("w").alias("c")), "id2").select("w", "c")


def edit(w: str, c: str) -> tuple[str, str]:
    """(meant, seen): the place in which ``w`` differs from ``c``."""
    n = min(len(w), len(c))
    i = 0
    while i < n and w[i] == c[i]:
        i += 1
    j = 0
    while j < n - i and w[-1 - j] == c[-1 - j]:
        j += 1
    return c[i : len(c) - j], w[i : len(w) - j]


class Noise:
    """Learned edits: (meant, seen) -> (words, log odds), and what follows from them."""

    def __init__(self, edits: dict[tuple[str, str], tuple[float, float]], signs: dict[tuple[str, str], tuple[float, float]] | None = None):
        self.edits, self.signs = edits, signs or {}
        self.sure = [(a, b, n) for (a, b), (n, odds) in edits.items() if a and b and n >= 3 and odds > 2]
        self.table = self._folds()

    def _folds(self) -> dict[int, str]:
        """Spelling in which what scanners mix up falls together: single signs by class, one sign for two as the two."""
        root: dict[str, str] = {}

        def find(x: str) -> str:
            while root.get(x, x) != x:
                x = root[x]
            return x

        single = [(a, b) for a, b, _ in self.sure if len(a) == len(b) == 1] + [k for k, (n, odds) in self.signs.items() if n >= 2 and odds > 2]
        for a, b in single:
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
        double: dict[str, tuple[float, str]] = {}
        for a, b, n in self.sure:
            for one, two in ((a, b), (b, a)):
                if len(one) == 1 and len(two) == 2 and one not in two:
                    double[find(one)] = max(double.get(find(one), (0.0, "")), (n, two))

        def spell(ch: str, over: frozenset) -> str:
            r = find(ch)
            if r in double and r not in over:
                return "".join(spell(x, over | {r}) for x in double[r][1])
            return r

        letters = {x for a, b, _ in self.sure for x in a + b} | {x for k in self.signs for x in k}
        return {ord(x): spell(x, frozenset()) for x in letters}

    def fold(self, text: str) -> str:
        return text.translate(self.table)

    def misread(self, word: str, r: random.Random, times: int = 1) -> str:
        """The word as a scanner might misread it."""
        for _ in range(times):
            can = [(a, b, i, n) for a, b, n in self.sure for i in range(len(word)) if word.startswith(a, i)]
            if not can:
                return word
            a, b, i, _ = r.choices(can, weights=[x[3] ** 0.5 for x in can])[0]
            word = word[:i] + b + word[i + len(a) :]
        return word

    def features(self, w: str, c: str, flow: float, printed: float) -> list[float]:
        """How a word and its candidate compare."""
        one = edit(w, c)
        if max(map(len, one)) <= GAP or not self.sure:
            parts = [one]
        else:
            parts = [(c[j1:j2], w[i1:i2]) for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, w, c, False).get_opcodes() if tag != "equal"]
        known = [self.edits.get(p, (0.0, -1.0)) for p in parts]
        gw, gc = bigrams(w), bigrams(c)
        both = len(gw & gc)
        return [
            both / (len(gw) + len(gc) - both), sum(max(len(a), len(b)) for a, b in parts), len(parts), min(k[1] for k in known), math.log1p(min(k[0] for k in known)),
            math.log1p(flow), math.log1p(printed), len(w), float(any(ch in "0123456789!|" for ch in w)), float(self.fold(w) == self.fold(c)),
        ]


FEATURES = 10


@lru_cache(maxsize=1 << 14)
def bigrams(word: str) -> frozenset[str]:
    p = f"^{word}$"
    return frozenset([p[i : i + 2] for i in range(len(p) - 1)])


_VOTES = pa.schema([("meant", pa.string()), ("seen", pa.string()), ("u", pa.float64()), ("b", pa.float64())])


def _votes(w: list[str], c: list[str], u: list[int], k: list[int]) -> Iterator[tuple]:
    return ((*edit(a, b), x / n, (1 - x) / n) for a, b, x, n in zip(w, c, u, k))


def weigh(rows: list, unknown: int, sound: int) -> dict[tuple[str, str], tuple[float, float]]:
    """(words, log odds) of each edit from its words among unknown and among known ones."""
    return {(r.meant, r.seen): (float(r.u), math.log((r.u + 0.5) / (unknown + 1)) - math.log((r.b + 0.5) / (sound + 1))) for r in rows}


def learn_edits(unknown: DataFrame, sound: DataFrame, vocab: DataFrame) -> dict[tuple[str, str], tuple[float, float]]:
    """Edits between ``unknown`` (w, n) words and words of ``vocab`` (w, n), weighed against those of known ``sound`` (w, n) words.

    A word shares its vote among its candidates; a candidate must be met more often than twice the word's count.
    """
    both = unknown.select("w", "n", F.lit(1).alias("u")).unionByName(sound.select("w", "n", F.lit(0).alias("u")))
    p = gapped_pairs(both, vocab).join(both, "w").join(vocab.select(F.col("w").alias("c"), F.col("n").alias("m")), "c").where("m > 2 * n")
    p = p.join(p.groupBy("w").agg(F.count("*").alias("k")), "w").select("w", "c", "u", "k")
    v = map_rows(p, _votes, _VOTES).groupBy("meant", "seen").agg(F.sum("u").alias("u"), F.sum("b").alias("b"))
    rows = v.where("u > 0").orderBy(F.desc("u"), "meant", "seen").limit(MOST_EDITS).collect()
    size = {r.u: r["count"] for r in both.groupBy("u").count().collect()}
    return weigh(rows, size.get(1, 0), size.get(0, 0))
