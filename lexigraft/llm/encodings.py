"""Finding and undoing text that was decoded with the wrong character encoding.

The corpus repairs itself: every distinct unit of the corpus (a word with a letter beyond ASCII, a
single such character, by itself and between its neighbours, one or two Han characters) is sent through every chain of encodings, and the
table (garbled form -> original) is hash-joined with the tokens of the documents. Only tokens equal
to a garbled form of a unit that occurs elsewhere are hits, so tree drawings, Greek letters and
accented capitals are left alone. Where a chain loses bytes, forms hold the replacement character in its
place. Hits are replaced by their originals; a document whose lost letters can not be told stays marked.

Work is linear: units are counted per batch before they move, tokens are distinct per document, and
both sides of the join are hashed on the token. Nothing is collected or broadcast.

Defined results: null, empty and ASCII texts have no hits; repeated texts are hit each; a garbled
form with several originals takes the most frequent one (ties: the greatest).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lexigraft.llm.arrow import map_rows, record_batch
from lexigraft.session import stored

LOST = "\ufffd"
_HANISH = "⺀-⿟　-鿿-﫿︰-﹏＀-￯"
_HAN_RUN = re.compile(f"[{_HANISH}]+")
_OTHER_RUN = re.compile(f"[^\x00-\x7f{_HANISH}]+")
_WORD = re.compile(r"[^\s!-&(-,./:-@\[-`{-~]{2,}")
_HAN_STOPS = re.compile("[\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\u2018-\u201d]+")
#: no sign's form is longer: four bytes, each read as a sign of at most three bytes
LONGEST = 12
#: two characters of three UTF-8 bytes each, as pairs of bytes
_TWO = re.compile(rb"(?=((?:[\xe3-\xe9][\x80-\xbf]{2}|\xef[\xbc\xbd][\x80-\xbf]){2}))")

# Chains of encodings, fixed values: what the bytes were -> what they were read as.
SINGLE = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "cp1253", "cp1254", "koi8-r", "cp866", "iso8859-15")
UTF8_AS = (*SINGLE, "gb18030", "big5", "cp932", "cp949")
HAN_AS = (("gb18030", d) for d in ("cp1252", "latin-1", "mac_roman", "cp1251", "cp437", "cp850", "utf-8", "big5", "cp932", "cp949"))
BIG5_AS = (("big5", d) for d in ("cp1252", "latin-1", "mac_roman", "utf-8", "gb18030"))
SWAPS = tuple(
    (a, b)
    for a, b in (("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "gb18030"), ("cp1252", "utf-8"))
)
CHAINS = (
    *((("utf-8", d),) for d in UTF8_AS),
    *((c,) for c in HAN_AS),
    *((c,) for c in BIG5_AS),
    *((("utf-8", a), ("utf-8", b)) for a in ("cp1252", "latin-1", "mac_roman") for b in ("cp1252", "latin-1", "mac_roman")),
)


def _one_byte(name: str) -> tuple[dict[str, int], str]:
    """Encoding table and decoding string of a one-byte set; bytes it leaves undefined stand for themselves."""
    dec = "".join(bytes([i]).decode(name, "ignore") or chr(i) for i in range(256))
    return {c: i for i, c in reversed(list(enumerate(dec)))}, dec


_TABLES = {n: _one_byte(n) for n in SINGLE}


def _encode(t: str, name: str) -> bytes | None:
    if name in _TABLES:
        try:
            return bytes(map(_TABLES[name][0].__getitem__, t))
        except KeyError:
            return None
    try:
        return t.encode(name)
    except UnicodeEncodeError:
        return None


def _decode(b: bytes, name: str) -> str:
    if name in _TABLES:
        dec = _TABLES[name][1]
        return "".join([dec[i] for i in b])
    return b.decode(name, "replace")


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text as it reads after the chain, or None where it can not have been written so."""
    for was, read in chain:
        b = _encode(text, was)
        if b is None:
            return None
        text = _decode(b, read)
    return text


def _words(text: str) -> Iterator[str]:
    for w in _WORD.findall(text):
        if not w.isascii():
            if not _HAN_RUN.search(w):
                yield w.strip("'-")
            else:  # signs among letters; what stands between two stops
                for part in _HAN_STOPS.split(w):
                    if len(part) > 1 and not part.isascii() and not _HAN_RUN.fullmatch(part):
                        yield part.strip("'-")


def _read_twice(run: str) -> list[str]:
    """Windows of three signs whose six bytes are two signs in UTF-8."""
    b = run.encode("gb18030") if len(run) > 2 else b""
    return [run[m.start() // 2 : m.start() // 2 + 3] for m in _TWO.finditer(b) if not m.start() & 1] if len(b) == 2 * len(run) else []


def _lost_places(text: str) -> set[str]:
    """Lost signs with what stands on both sides, as ``forms_of`` a letter in its place."""
    return {m[0] for m in _LOST_AT.finditer(text)}


_LOST_AT = re.compile("[^\\W\\d_]\ufffd+[^\\W\\d_]")
_IN_PLACE = re.compile("(?=([^\\W\\d_][^\x00-\x7f\ufffd][^\\W\\d_]))")


def units_of(text: str) -> set[str]:
    """What the text offers as originals."""
    # a word is written in letters, signs of currency, figures and the like are none
    out = {w for w in _words(text) if not _HAN_RUN.search(w) and all(c < "\x80" or unicodedata.category(c)[0] in "LMP" for c in w)}
    for run in _OTHER_RUN.findall(text):
        out.update(run)
    for m in _IN_PLACE.findall(text):
        if not _HAN_RUN.search(m):
            out.add("\0" + m)  # a letter between its neighbours
    for run in _HAN_RUN.findall(text):
        if 6 * len(_read_twice(run)) < max(6, len(run)):  # else the signs are bytes of others, read in twos
            out.update(run)
            out.update(map("".join, zip(run, run[1:])))
    return {u for u in out if LOST not in u}


def tokens_of(text: str) -> set[str]:
    """What of the text may be garbled."""
    out = set(_words(text))
    if LOST in text:
        out |= _lost_places(text)
    for run in _OTHER_RUN.findall(text):
        for n in range(2, LONGEST + 1):
            out.update(run[i : i + n] for i in range(len(run) - n + 1))
    for run in _HAN_RUN.findall(text):
        out.update(_read_twice(run))
    return out


def forms_of(unit: str) -> Iterator[tuple[str, bool]]:
    """(garbled form, needs a frequency check) of a unit under every chain; lost bytes stand as they are read."""
    if unit[0] == "\0":  # one letter lost between its neighbours: as one sign, or as one for each of its bytes
        a, m, b = unit[1:]
        yield from {(a + LOST * n + b, False) for n in (1, len(m.encode("utf-8", "replace")))}
        return
    one = len(unit) == 1
    han = bool(_HAN_RUN.fullmatch(unit))
    seen = {unit}
    for chain in CHAINS:
        two_byte = chain[0][0] != "utf-8"
        if two_byte and (one or not han) or han and not one and not two_byte and chain[0][1] not in ("gb18030", "big5", "cp932", "cp949"):
            continue
        f = garble(unit, chain)
        if f is None:
            continue
        f = f.strip(" \t\r\n\xa0'-") if not one else f
        if f in seen or f.isascii() or len(f) < 2 or not f.strip(LOST):
            continue
        if _HAN_RUN.fullmatch(f) and len(f) != 3:  # two signs of three bytes are read as three of two
            continue
        seen.add(f)
        yield f, False
    if len(unit) > 3 and not han:
        for swap in SWAPS:
            f = garble(unit, (swap,))
            if f is not None and f not in seen and not f.isascii():
                seen.add(f)
                yield f, LOST not in f


_READ = pa.schema([("doc_id", pa.int64()), ("tokens", pa.list_(pa.string())), ("unit", pa.string()), ("n", pa.int64())])
_FORMS = pa.schema([("form", pa.string()), ("original", pa.string()), ("n", pa.int64()), ("swap", pa.bool_())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each text, and units with their counts: each text is read once."""
    for batch in batches:
        n: Counter = Counter()
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n.update(units_of(text))
            tokens = tokens_of(text)
            if tokens:
                rows.append((doc, list(tokens), None, None))
        yield record_batch([*rows, *((None, None, u, k) for u, k in n.items())], _READ)


def _form_rows(units: list[str], n: list[int]) -> Iterator[tuple]:
    return ((f, u.lstrip("\0"), k, check) for u, k in zip(units, n) for f, check in forms_of(u))


class Garbled:
    """Tokens, units and forms of a corpus, each written once."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
        t = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(F.col("text").rlike(r"[^\x00-\x7f]"))
        read = stored(t.mapInArrow(_read, from_arrow_schema(_READ)))
        self.tokens = read.where("tokens is not null").select("doc_id", F.explode("tokens").alias("form"))
        units = stored(read.where("unit is not null").groupBy("unit").agg(F.sum("n").alias("n")))
        parts = max(1, units.count() // 4000)  # forms cost by unit, not by byte
        forms = stored(map_rows(units.repartition(parts), _form_rows, _FORMS))
        plain = forms.where("not swap")
        seen = units.select(F.col("unit").alias("form"), F.col("n").alias("seen"))
        # a form that is also a word of another language counts only where its original is far more common
        swaps = forms.where("swap").join(seen, "form").where("seen * 4 <= n").drop("seen")
        # what is garbled itself is no original
        garbled = plain.select(F.col("form").alias("original")).distinct()
        every = plain.unionByName(swaps).join(garbled, "original", "left_anti")
        self.table = every.groupBy("form").agg(F.max_by("original", F.struct("n", "original")).alias("original"))

    def hits(self) -> DataFrame:
        """(doc_id, form, original): the garbled tokens of every document."""
        return self.tokens.join(self.table, "form").select("doc_id", "form", "original").distinct()


def garbled_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """(form, original) of every unit of the corpus under every chain."""
    return Garbled(docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text}`").alias("text"))).table


def garbled_hits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, form, original): the garbled tokens of every document."""
    return Garbled(docs, doc_id, text).hits()


def _restore(text: str, forms: list[str], originals: list[str]) -> str:
    # what lost its bytes has its original where the word is known, not where a letter is guessed from its neighbours
    known = {f: o for f, o in zip(forms, originals) if LOST not in f or len(f) > 3 and not _LOST_AT.fullmatch(f) and not _HAN_RUN.search(o)}
    # the last byte of some letters reads as a blank, which belongs to no word
    known |= {f + "\xa0": o for f, o in known.items() if not f[-1].isascii() and any(garble(o, c) == f + "\xa0" for c in CHAINS)}
    if not known:
        return text
    longest_first = re.compile("|".join(map(re.escape, sorted(known, key=len, reverse=True))))
    return longest_first.sub(lambda m: known[m[0]], text)


@F.pandas_udf(T.StringType())
def _restored(text: pd.Series, forms: pd.Series, originals: pd.Series) -> pd.Series:
    return pd.Series([_restore(t, list(f), list(o)) for t, f, o in zip(text, forms, originals)], dtype=object)


def repaired(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, restored): affected documents with originals put back; ``restored`` is false where bytes are lost."""
    hits = garbled_hits(docs, doc_id, text).groupBy("doc_id").agg(F.collect_list(F.struct("form", "original")).alias("h"))
    t = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = t.join(hits, "doc_id").withColumn("text", _restored("text", "h.form", "h.original"))
    return out.select("doc_id", "text", (~F.col("text").contains(LOST)).alias("restored"))
