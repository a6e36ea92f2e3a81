"""Byte-pair encoding by prefix dynamic programming.

For every byte prefix of a word there is exactly one token that can stand last in the prefix's
encoding. ``PrefixEncoding`` stores that token per prefix. It is found by trying the tokens that
end there: the one whose predecessor (the last token of the shorter prefix) may stand beside it.
Two tokens may stand side by side if encoding their bytes gives just the two, which is decided by
undoing merges from the boundary outwards and is remembered per pair. Reading the last tokens
backwards gives the encoding of any prefix, so appending bytes costs only the new positions, and
an edit re-encodes from the edit's start.

Defined results: null and empty texts have the empty list; strings that spell special tokens are
ordinary text; repeated texts have equal lists. Texts of any length are encoded piece by piece
(the tokenizer's own split pattern bounds nothing, a single unbroken run is still linear).
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigraft.functions.workers import per_worker

#: split pattern of the byte_bpe vocabularies (fixed value, given with the vocabulary files)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = os.environ.get("LEXIGRAFT_TOKENIZERS", "/opt/tokenizers")


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token, blank, rank, on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens, the pair each was merged from, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.beside: dict[int, bool] = {}
        self.sound: set[int] = set()
        #: last byte -> lengths of tokens ending in it, shortest first
        ends: dict[int, set[int]] = {}
        for tok, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(tok) > 1:
                parts = self._merge(tok, i)
                if len(parts) == 2:
                    self.halves[i] = parts
                    self.merged[parts] = i
                else:
                    continue
            self.sound.add(i)
            ends.setdefault(tok[-1], set()).add(len(tok))
        self.lengths = {b: sorted(n) for b, n in ends.items()}

    def _merge(self, tok: bytes, below: int) -> tuple[int, ...]:
        """The token's bytes merged with the ranks under its own: its two halves."""
        parts = [tok[i : i + 1] for i in range(len(tok))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], below)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts)

    def fits(self, left: int, right: int) -> bool:
        """True if no merge would cross the boundary between the two tokens before they are whole."""
        key = left << 20 | right
        known = self.beside.get(key)
        if known is None:
            known = self.beside[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        # At any time the tokens that touch the boundary are one of the left's right flank and one of
        # the right's left flank; they grow in rank order. Going back in time, the younger of the two is
        # taken apart. A merge across the boundary happens if its rank comes before the next growth.
        halves, merged = self.halves, self.merged
        grown = 1 << 30  # rank of the merge that ends the period looked at
        while True:
            across = merged.get((left, right))
            if across is not None and across < grown:
                return False
            lr = left if left in halves else -1
            rr = right if right in halves else -1
            if lr < 0 and rr < 0:
                return True
            # of equal merges the left one comes first, so the right one is undone first
            if lr > rr:
                grown = lr
                left = halves[left][1]
            else:
                grown = rr + 1
                right = halves[right][0]


class PrefixEncoding:
    """The encoding of a growing word: ``last[i]`` is the last token of the prefix of i + 1 bytes."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last, self.size = vocab, b"", [], []
        self.append(data)

    def append(self, more: bytes) -> None:
        v, start = self.vocab, len(self.data)
        data = self.data = self.data + more
        ranks, fits, lengths, last, size = v.ranks, v.fits, v.lengths, self.last, self.size
        sound = v.sound
        for end in range(start + 1, len(data) + 1):
            for n in lengths[data[end - 1]]:
                if n > end:
                    raise ValueError("no encoding")
                tok = ranks.get(data[end - n : end])
                if tok is None or tok not in sound:
                    continue
                if n == end or fits(last[end - n - 1], tok):
                    last.append(tok)
                    size.append(n)
                    break
            else:
                raise ValueError("no encoding")

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Edit bytes [start, stop): prefixes before the edit keep what is stored for them."""
        tail = new + self.data[stop:]
        self.data = self.data[:start]
        del self.last[start:], self.size[start:]
        self.append(tail)

    def tokens(self, length: int | None = None) -> list[int]:
        at, out = len(self.data) if length is None else length, []
        while at:
            out.append(self.last[at - 1])
            at -= self.size[at - 1]
        return out[::-1]


class Encoder:
    """Texts to ids; words seen before are remembered up to ``cache`` entries."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, cache: int = 1 << 17):
        import regex

        self.vocab, self.words, self.cache = Vocabulary(ranks), {}, cache
        self.split = regex.compile(pattern).findall

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        words, out = self.words, []
        for w in self.split(text):
            ids = words.get(w)
            if ids is None:
                ids = PrefixEncoding(self.vocab, w.encode("utf-8", "replace")).tokens()
                if len(w) <= 64:
                    if len(words) >= self.cache:
                        words.clear()
                    words[w] = ids
            out += ids
        return out


def encode_column(df: DataFrame, text: str, ranks_path: str, out: str = "ids") -> DataFrame:
    """``df`` with an array of ids. The vocabulary (one file of fixed size) is broadcast once."""
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = per_worker("encoder", ranks_path, lambda: Encoder(ranks.value))
        for s in batches:
            yield pd.Series([e.encode(t) for t in s], dtype=object)

    return df.withColumn(out, encode(F.col(f"`{text}`")))
