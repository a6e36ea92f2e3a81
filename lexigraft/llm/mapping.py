"""Mapping free-entered values to a canonical list.

A prefix-filtered set-similarity join over character bigrams. The tokens of all distinct values are
counted, every value's tokens are ordered from rare to common, and only the first
``n - ceil(t * n) + 1`` of them (t: the least Jaccard similarity) are joined: two sets that are
similar enough must share one. Length and positional filters discard most candidates, Jaccard is
then verified exactly, and an exact check of words and edits ranks what is left.

Values are folded first (look-alikes, case, accents, brackets, set phrases of doubt or status around
the name), and distinct folded values are joined, not rows, so a value that holds a third of all rows
costs one join row. A second key, the words of a value in sorted order, covers reordered names; a
third, its leading word, covers names whose last word was replaced by a general one (disease,
condition): both are equi-joins too.

Defined results
* null and blank values have no row; values equal to a canonical name, character for character,
  have none either; all others have exactly one row per id and field, with 0 for no entry;
* placeholders (n/a, unknown, 无, ...) have no entry;
* of several entries equally near the one that is met more often in the data wins, then the
  smallest id; names listed twice resolve to the smallest id;
* an empty canonical list maps everything to 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigraft.functions.text import is_blank
from lexigraft.llm.confusables import Skeletons
from lexigraft.session import stored

# What people write around a name, in place of one, or for its last word.
BEFORE = ("suspected", "probable", "possible", "likely", "hx of", "history of", "h o", "query", "rule out", "r o", "s p", "known", "type", "category", "kind", "疑似", "可能", "考虑", "既往", "类型", "疑")
AFTER = ("confirmed", "nos", "unspecified", "suspected", "query", "轻", "重", "待查", "复诊", "确诊", "轻度", "重度")
NOTHING = frozenset(
    ("", "n a", "na", "none", "null", "nil", "unknown", "not stated", "not known", "not applicable", "see above", "see below", "same as before", "as per chart", "illegible", "tbd", "to be determined", "other", "misc", "无", "待查", "不详", "未知", "其他", "其它", "同上", "见上", "未记录", "不明", "暂无")
)
GENERAL = ("disease", "condition", "disorder")
SPELLINGS = (("oe", "e"), ("ae", "e"))
GREEK_NAMES = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta"}
TRADITIONAL = dict(zip("嵐證霧劑脹蒼銀絡陽陰氣腎膽腦熱濕風痺經脈藥瘀虛實營衛湯黃綠藍紅葉藤參麥術歸連門龍鳳雲靈鳥蘭薑棗葛筋頭體關節腫", "岚证雾剂胀苍银络阳阴气肾胆脑热湿风痹经脉药瘀虚实营卫汤黄绿蓝红叶藤参麦术归连门龙凤云灵鸟兰姜枣葛筋头体关节肿"))
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
_HAN = "㐀-䶿一-鿿"
_HAS_HAN = re.compile(f"[{_HAN}]")
#: a Greek letter that is a word, or a small one that begins a word
_GREEK = re.compile(r"(?<![^\W_])(?:[αβγδ]|[ΑΒΓΔ](?![^\W_]))")
_GAPS = re.compile(r"[\W_]+")
_B4 = re.compile("^(?:(?:" + "|".join(map(re.escape, (b for b in BEFORE if b.isascii()))) + r")\s+(?!\d)|(?:" + "|".join(b for b in BEFORE if not b.isascii()) + "))")
_AF = re.compile(r"(?:\s+(?:" + "|".join(a for a in AFTER if a.isascii()) + r")|\s(?:" + "|".join(a for a in AFTER if not a.isascii()) + "))$")


class Folding:
    """Comparison form of a value."""

    def __init__(self) -> None:
        self.sk = Skeletons()
        self.simple = str.maketrans(TRADITIONAL)

    def plain(self, value: str) -> str:
        if not value.isascii():
            value = "".join(c for c in unicodedata.normalize("NFKC", value) if unicodedata.category(c) != "Cf")
            value = _GREEK.sub(lambda m: GREEK_NAMES[m[0].casefold()] + " ", value)
        t = unicodedata.normalize("NFKD", self.sk.of(value).casefold())
        t = "".join(c for c in t if not unicodedata.combining(c))
        for a, b in SPELLINGS:
            t = t.replace(a, b)
        t = t.replace("'s ", " ")
        t = _GAPS.sub(" ", t.translate(self.simple)).strip()
        return " ".join(_ROMAN.get(w, w) if n else w for n, w in enumerate(t.split()))

    def of(self, value: str) -> str:
        t = self.plain(value)
        while t not in NOTHING:
            s = _AF.sub("", _B4.sub("", t)).strip()
            if s == t or not s:
                break
            t = s
        if _HAS_HAN.search(t):
            t = re.sub(rf"(?<=[{_HAN}])\s+(?=[{_HAN}])", "", t)
        return t


@F.pandas_udf(T.StringType())
def fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    f = Folding()
    for s in batches:
        seen = {v: None if v is None else f.of(v) for v in s.unique()}
        yield s.map(seen)


def _grams(c: Column) -> Column:
    """Distinct bigrams of the padded text."""
    p = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - 1), lambda i: F.substring(p, i, F.lit(2))))


def similar_pairs(left: DataFrame, right: DataFrame, least: float | dict[str, float]) -> DataFrame:
    """(kind, value, form, jaccard): pairs of distinct ``left.value`` and ``right.form`` of one kind with Jaccard of at least ``least``.

    Both sides hold distinct texts by ``kind`` (a column either has, or neither: then it is empty);
    ``least`` may differ by kind. Token order comes from counts over all texts of both sides. Only numbers
    pass the join, which applies the length and the positional filter itself: what two sets share is at most
    the tokens before the shared one, it, and the tokens behind it. Its cost is rows and not bytes, so it is
    cut by rows. Texts are joined back to the pairs that are left, and Jaccard is verified exactly.
    """
    if "kind" not in left.columns:
        left, right, least = left.withColumn("kind", F.lit("")), right.withColumn("kind", F.lit("")), {"": least}
    t = F.create_map(*[F.lit(x) for kv in least.items() for x in kv])[F.col("kind")]
    both = left.select("kind", F.col("value").alias("text"), F.lit(0).alias("side")).unionByName(right.select("kind", F.col("form").alias("text"), F.lit(1).alias("side")))
    each = both.withColumn("g", _grams(F.col("text"))).select("kind", F.xxhash64("kind", "text").alias("id"), "side", F.size("g").alias("n"), F.explode("g").alias("tok"))
    each = each.select("id", "side", "n", t.alias("t"), F.xxhash64("kind", "tok").alias("tok"))
    rarity = each.groupBy("tok").agg(F.count("*").alias("df"))
    ordered = each.join(rarity, "tok").groupBy("id", "side", "n", "t").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("o"))
    prefix = (F.col("n") - F.ceil(F.col("t") * F.col("n")) + 1).cast("int")
    pre = stored(ordered.select("id", "side", "n", "t", F.posexplode(F.slice("o", F.lit(1), prefix)).alias("pos", "o")).select("id", "side", "n", "t", "pos", "o.tok"))
    parts = max(left.sparkSession.sparkContext.defaultParallelism, pre.count() // 20_000)
    a = pre.where("side = 0").select("tok", "id", "t", F.col("n").alias("na"), F.col("pos").alias("pa")).repartition(parts, "tok")
    b = pre.where("side = 1").select("tok", F.col("id").alias("id2"), F.col("n").alias("nb"), F.col("pos").alias("pb")).repartition(parts, "tok")
    need = F.col("t") / (1 + F.col("t")) * (F.col("na") + F.col("nb"))
    most = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    near = a.join(b, (a["tok"] == b["tok"]) & (F.least("na", "nb") >= F.col("t") * F.greatest("na", "nb")) & (most >= need - 1e-9))
    # all prefix tokens a pair shares, and what may follow the last of them
    met = near.groupBy("id", "id2", "na", "nb", "t").agg(F.count("*").alias("met"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    near = met.where(F.col("met") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1 >= need - 1e-9).select("id", "id2")
    pairs = near.join(left.select(F.xxhash64("kind", "value").alias("id"), "kind", "value"), "id").join(right.select(F.xxhash64("kind", "form").alias("id2"), "form"), "id2")
    one, two = _grams(F.col("value")), _grams(F.col("form"))
    shared = F.size(F.array_intersect(one, two))
    return pairs.select("kind", "value", "form", (shared / (F.size(one) + F.size(two) - shared)).alias("jaccard"), t.alias("t")).where("jaccard >= t").drop("t")


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, replacements and swaps of neighbours, or ``most + 1`` if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row[j] = v
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def distance(value: str, form: str, most: int = 3) -> float:
    """How far a folded value is from a canonical form; over ``most`` is no match.

    Numbers must agree. Words are compared in order, then sorted; a word may be cut short
    (three letters or more), blanks may be missing, a last word may be a general one.
    """
    if value == form:
        return 0.0
    if re.findall(r"\d+", value) != re.findall(r"\d+", form):
        if sorted(re.findall(r"\d+", value)) != sorted(re.findall(r"\d+", form)):
            return most + 1.0
    if value.replace(" ", "") == form.replace(" ", ""):
        return 0.1
    v, f = value.split(), form.split()
    if sorted(v) == sorted(f):
        return 0.2
    if value.endswith("ies") and form.endswith("y") and value[:-3] == form[:-1]:
        return 0.3
    best = float(edits(value, form, most))
    if len(v) == len(f):
        for extra, (p, q) in ((0.3, (v, f)), (0.5, (sorted(v), sorted(f)))):
            cost = extra
            for x, y in zip(p, q):
                if x != y:
                    cost += 0.1 if len(x) >= 3 and y.startswith(x) else edits(x, y, most)
            best = min(best, cost)
    if v and f and v[-1] in GENERAL and len(v) == len(f) and f[-1] not in GENERAL:
        head = edits(" ".join(v[:-1]), " ".join(f[:-1]), most)
        best = min(best, 0.6 + head)
    if v and f and len(v) == len(f) + 1 and v[-1] in GENERAL:
        best = min(best, 0.6 + edits(" ".join(v[:-1]), form, most))
    return best


@F.pandas_udf(T.DoubleType())
def _distances(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([distance(x, y) for x, y in zip(a, b)], dtype=float)


def _allowed(form: Column) -> Column:
    """Edits accepted in a form of this length: names in Han are short, one sign decides much."""
    n = F.length(form)
    return F.when(form.rlike(f"[{_HAN}]"), F.when(n >= 4, 1.0).otherwise(0.5)).when(n >= 12, 3.0).when(n >= 6, 2.0).otherwise(1.0)


def _settled(values: DataFrame, forms: DataFrame) -> DataFrame:
    """(kind, value): Han values of a consistent foreign sign.

    A sign that no canonical form has and that stands in one place in most of the distinct values
    holding it makes names of its own; signs put in by mistake stand anywhere.
    """
    han = values.where(F.col("value").rlike(f"^[{_HAN}]+$"))
    signs = han.select("kind", "value", F.posexplode(F.split("value", "")).alias("at", "sign")).where("sign <> ''")
    known = forms.select("kind", F.explode(F.split("form", "")).alias("sign")).distinct()
    foreign = signs.join(known, ["kind", "sign"], "left_anti")
    # a sign put into a name is none of its own
    foreign = foreign.withColumn("form", F.expr("replace(value, sign, '')")).join(forms.select("kind", "form"), ["kind", "form"], "left_anti").drop("form")
    foreign = stored(foreign)
    slots = foreign.groupBy("kind", "sign", "at").agg(F.count("*").alias("n"))
    shape = slots.groupBy("kind", "sign").agg(F.sum("n").alias("all"), F.max(F.struct("n", "at")).alias("top"))
    makers = shape.where((F.col("all") >= 4) & (F.col("top.n") >= 0.85 * F.col("all"))).select("kind", "sign", F.col("top.at").alias("at"))
    return foreign.join(makers, ["kind", "sign", "at"]).select("kind", "value").distinct()


def map_values(values: DataFrame, forms: DataFrame, least: dict[str, float]) -> DataFrame:
    """(kind, value, canon_id, route) of the folded values that have an entry.

    ``values``: distinct (kind, value, n) with counts; ``forms``: (kind, form, canon_id), folded names and
    aliases. ``route`` tells what found the entry: equal forms, the similarity join, or one of the further keys.
    """
    exact = stored(forms.groupBy("kind", "form").agg(F.min("canon_id").alias("canon_id")))
    equal = [values["kind"] == exact["kind"], values["value"] == exact["form"]]
    named = stored(values.join(exact, equal, "left").select(values["kind"], "value", "n", "canon_id"))
    hits = named.where("canon_id is not null")
    met = hits.groupBy("kind", "canon_id").agg(F.sum("n").alias("met"))
    nothing = F.col("value").isin(*sorted(NOTHING))
    rest = named.where(F.col("canon_id").isNull() & ~nothing).select("kind", "value")
    rest = stored(rest.join(_settled(rest, exact), ["kind", "value"], "left_anti"))
    near = similar_pairs(rest, exact.select("kind", "form"), least).withColumn("route", F.lit("similar"))
    words = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ")
    head = lambda c: F.regexp_replace(c, " [^ ]+$", "")
    # two further keys of a value, in one join: its words in order, and the words before a general last one
    general = F.col("value").rlike(" (" + "|".join(GENERAL) + ")$")
    key = lambda route, c: F.struct(F.lit(route).alias("route"), c.alias("w"))
    asked = rest.select("kind", "value", F.explode(F.array(key("words", words("value")), key("head", F.when(general, head(F.col("value")))))).alias("k")).select("kind", "value", "k.*")
    given = exact.select("kind", "form", F.explode(F.array(key("words", words("form")), key("head", head(F.col("form"))))).alias("k")).select("kind", "form", "k.*")
    further = asked.join(given, ["kind", "route", "w"]).select("kind", "value", "form", F.when(F.col("route") == "words", 1.0).otherwise(0.0).alias("jaccard"), "route")
    cand = near.select("kind", "value", "form", "jaccard", "route").unionByName(further).groupBy("kind", "value", "form").agg(F.max("jaccard").alias("jaccard"), F.max("route").alias("route"))
    judged = stored(cand.withColumn("d", _distances("value", "form")).where(F.col("d") <= _allowed(F.col("form")) + 0.6))
    ranked = judged.join(exact, ["kind", "form"]).join(met, ["kind", "canon_id"], "left")
    order = F.struct(F.col("d"), -F.coalesce("met", F.lit(0)), -F.col("jaccard"), "canon_id")
    best = ranked.groupBy("kind", "value").agg(F.min_by(F.struct("canon_id", "route"), order).alias("b")).select("kind", "value", "b.canon_id", "b.route")
    return stored(hits.where(~nothing).select("kind", "value", "canon_id", F.lit("equal").alias("route")).unionByName(best))


def map_fields(fields: list[tuple]) -> DataFrame:
    """(id, field, canon_id, route) for every row whose value is neither null, blank nor a canonical name.

    ``fields``: (rows, key, column, canon, canon_id, canon_name, aka, field, least); all fields go through
    the same joins, told apart by ``field``.
    """
    raws, canons, least = None, None, {}
    both = lambda x, y: y if x is None else x.unionByName(y)
    for rows, key, column, canon, canon_id, canon_name, aka, field, t in fields:
        c = canon.select(F.lit(field).alias("kind"), F.col(f"`{canon_id}`").cast("bigint").alias("canon_id"), F.col(f"`{canon_name}`").alias("name"), F.col(f"`{aka}`").alias("aka"))
        r = rows.select(F.lit(field).alias("kind"), F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").alias("raw"))
        raws, canons, least[field] = both(raws, r), both(canons, c), t
    canons = canons.where("name is not null")
    names = canons.select("kind", F.col("name").alias("raw")).distinct()
    listed = canons.select("kind", "canon_id", F.explode(F.concat(F.array("name"), F.coalesce("aka", F.array().cast("array<string>")))).alias("raw")).where("raw is not null")
    forms = listed.withColumn("form", fold("raw")).where("form <> ''").select("kind", "form", "canon_id").distinct()
    raws = raws.where("raw is not null")
    counted = stored(raws.distinct().groupBy("kind", "raw").agg(F.count("*").alias("n")).withColumn("value", fold("raw")))
    mapped = map_values(counted.groupBy("kind", "value").agg(F.sum("n").alias("n")), forms, least)
    by_raw = counted.where(~is_blank(F.col("raw"))).join(names, ["kind", "raw"], "left_anti").select("kind", "raw", "value")
    by_raw = stored(by_raw.join(mapped, ["kind", "value"], "left").select("kind", "raw", F.coalesce("canon_id", F.lit(0)).cast("bigint").alias("canon_id"), F.coalesce("route", F.lit("none")).alias("route")))
    return raws.join(by_raw, ["kind", "raw"]).select("id", F.col("kind").alias("field"), "canon_id", "route").distinct()


def map_entries(
    rows: DataFrame, key: str, column: str, canon: DataFrame, canon_id: str, canon_name: str, aka: str, field: str, least: float = 0.5
) -> DataFrame:
    """(id, field, canon_id) of one field; see ``map_fields``."""
    return map_fields([(rows, key, column, canon, canon_id, canon_name, aka, field, least)]).select("id", "field", "canon_id")
