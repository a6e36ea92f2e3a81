"""One consistent form for text that looks the same.

``skeleton`` follows the confusables procedure: decompose (compatibility forms included), drop what
shows nothing, replace each character by its prototype from a look-alike table, decompose again.
Texts look the same if their skeletons are equal. ``canonical`` is the form to store: the skeleton
composed again.

The look-alike table (``lookalike_table``) maps letters of other scripts to the Latin or Han sign they are drawn like.
Signs of one script are never merged (l and I, 0 and O), nor are case, accents or spelling.

Defined results: null stays null, empty stays empty; a text of invisible characters only becomes
empty; texts of any length are linear; repeated texts are computed once per batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigraft.session import stored

# Letters drawn like a letter of another script, where names call for a closer or another match than the library's table.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХУЗаеорсухіјѕԁһԛԝѵᴦвкмнтпгЬбьԌԜҮҺӀӏ", "ABESIJKMHOPCTXY3aeopcyxijsdhqwvrвкмнтпгb6ьGWYhlI"))
CYRILLIC = {k: v for k, v in CYRILLIC.items() if k != v}
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαγικνορτυχϲϳ", "ABEZHIKMNOPTYXayiκvopτuχcj"))
GREEK = {k: v for k, v in GREEK.items() if k != v}
OTHER_LATIN = dict(zip("ՏՍԼօոսհզցյᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "SULonuhqgjABCDEHJKLMPRSTVWZ"))
HAN = dict(zip("ロニエハトタカーノチ", "口二工八卜夕力一丿千"))
DOTLESS = {"ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "L"}
LOOKALIKES = {**CYRILLIC, **GREEK, **OTHER_LATIN, **HAN, **DOTLESS}
HYPHENS = "‐‑‒–—―−⁃﹘﹣－➖˗۔⸺⸻ー"
QUOTES = {"‘": "'", "’": "'", "‛": "'", "′": "'", "`": "'", "´": "'", "“": '"', "”": '"', "„": '"', "″": '"'}
#: show nothing though they are letters or marks: fillers, joiners, variation selectors
HIDDEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x2800, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0x180B, 0x1810)}


def lookalike_table(spark: SparkSession) -> dict[str, str]:
    """Letters of one script -> the letters of another they are drawn like, from the confusables data in Spark's own ICU library.

    Its prototypes also join signs of one script (l, I and 1; O and 0; rn and m): a letter is given the
    member of such a class that has its case. Only letters whose prototype is of another script are kept,
    some hundred whatever the data; the fixed values above go first. A Spark without that library is an
    error: the fixed values alone would miss pairs.
    """
    if "letters" not in _TABLE:
        letters = [chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] == "L" and not 0xAC00 <= c <= 0xD7A3]
        try:
            checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        except TypeError as e:  # no such class
            raise RuntimeError("the ICU library (icu4j), whose table of look-alikes is needed, is not among Spark's jars") from e
        looks = checker.getSkeleton("\n".join(letters)).split("\n")
        if len(looks) != len(letters):
            raise RuntimeError(f"the ICU library gave {len(looks)} look-alikes for {len(letters)} letters")
        _TABLE["letters"] = dict(filter(None, map(_other_script, letters, looks))) | LOOKALIKES
    return _TABLE["letters"]


_TABLE: dict[str, dict[str, str]] = {}


def _script(ch: str) -> str:
    return unicodedata.name(ch, "?").split()[0].split("-")[0]


def _other_script(ch: str, look: str) -> tuple[str, str] | None:
    if look == "rn":
        look = "m"
    if look in ("l", "O"):
        upper = unicodedata.category(ch) == "Lu"
        look = ("I" if upper else "l") if look == "l" else ("O" if upper or unicodedata.category(ch) != "Ll" else "o")
    if look == ch or len(look) != 1 or not (look.isascii() and look.isalnum() or _script(look) == "CJK") or unicodedata.normalize("NFKD", ch) != ch:
        return None
    return (ch, look) if _script(ch) not in ("LATIN", _script(look)) else None


class Skeletons:
    """Character table filled as characters are met, so a text costs one ``translate``."""

    def __init__(self, looks: dict[str, str] = LOOKALIKES) -> None:
        self.table: dict[int, str | None] = {}
        self.looks = looks

    def one(self, ch: str) -> str:
        code = ord(ch)
        if ch in HYPHENS and ch != "ー":
            return "-"
        if ch in QUOTES:
            return QUOTES[ch]
        if ch in self.looks:
            return self.looks[ch]
        kind = unicodedata.category(ch)
        if kind in ("Cf", "Cc") and not ch.isspace() or code in HIDDEN or 0xE0000 <= code <= 0xE0FFF:
            return ""
        if ch.isspace() or kind == "Zs":
            return " "
        return ch

    def of(self, text: str | None) -> str | None:
        if text is None or text.isascii() and text.isprintable() and "`" not in text:
            return text
        t = unicodedata.normalize("NFKD", "".join("" if unicodedata.category(c) == "Cf" else QUOTES.get(c, c) for c in text))
        table = self.table
        out = []
        for ch in t:
            p = table.get(ch)
            if p is None:
                p = table[ch] = self.one(ch)
            out.append(p)
        return unicodedata.normalize("NFKD", "".join(out))


def skeleton(text: str | None) -> str | None:
    return Skeletons().of(text)


def canonical(text: str | None) -> str | None:
    s = Skeletons().of(text)
    return None if s is None else unicodedata.normalize("NFC", s)


def _udf(spark: SparkSession, compose: bool):
    looks = lookalike_table(spark)

    @F.pandas_udf(T.StringType())
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sk = Skeletons(looks)
        for s in batches:
            seen = {t: sk.of(t) for t in set(s)}
            if compose:
                seen = {t: None if x is None else unicodedata.normalize("NFC", x) for t, x in seen.items()}
            yield pd.Series([seen[t] for t in s], dtype=object)

    return form


def _plain(c: Column) -> Column:
    """ASCII text without controls and backquotes is its own skeleton and skips Python."""
    return ~c.rlike(r"[^\x20-\x5f\x61-\x7e]")


def with_form(df: DataFrame, name: str, out: str, compose: bool = False) -> DataFrame:
    """``df`` with the skeleton (``compose``: the canonical form) of a text column."""
    c = F.col(f"`{name}`")
    plain = F.coalesce(_plain(c), F.lit(True))
    return df.where(plain).withColumn(out, c).unionByName(df.where(~plain).withColumn(out, _udf(df.sparkSession, compose)(c)))


def lookalike_pairs(df: DataFrame, key: str, name: str, group: str) -> DataFrame:
    """(id_a, id_b) of rows of one group whose names differ in characters and look the same.

    A pre-aggregated pass over hashes finds the (group, skeleton) classes with more than one spelling; they
    are written, so the planner knows their size and moves no row to them where they are few. Only rows of
    such classes are merged by (key, name, group) and meet each other, by an equi-join that adaptive
    execution may split: a hot group, or a name of equal characters however often, costs one row there.
    """
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{name}`").alias("n"), F.col(f"`{group}`").alias("g"))
    rows = with_form(rows.where("n is not null and g is not null and k is not null"), "n", "s").withColumn("h", F.xxhash64("g", "s"))
    spelt = F.xxhash64("n")
    mixed = stored(rows.groupBy("h").agg(F.min(spelt).alias("lo"), F.max(spelt).alias("hi")).where("lo <> hi").select("h"))
    few = rows.join(mixed, "h", "left_semi").select("k", "n", "g", "s").distinct()
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.k") < F.col("b.k")) & (F.col("a.n") != F.col("b.n")))
    return pairs.select(F.col("a.k").alias("id_a"), F.col("b.k").alias("id_b")).distinct()


def lookalike_classes(df: DataFrame, key: str, name: str, group: str) -> DataFrame:
    """(id, class, links): the rows of ``lookalike_pairs`` once each, with the number of rows that look the same and are spelt otherwise."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{name}`").alias("n"), F.col(f"`{group}`").alias("g"))
    rows = with_form(rows.where("n is not null and g is not null and id is not null"), "n", "s").distinct()
    spelt = rows.groupBy("g", "s", "n").agg(F.count("*").alias("m"))
    size = spelt.groupBy("g", "s").agg(F.sum("m").alias("all"), F.count("*").alias("spellings")).where("spellings > 1")
    n = spelt.join(size, ["g", "s"]).select("g", "n", F.xxhash64("g", "s").alias("class"), (F.col("all") - F.col("m")).alias("links"))
    return rows.join(n, ["g", "n"]).select("id", "class", "links")
