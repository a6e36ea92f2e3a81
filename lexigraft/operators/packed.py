"""Several values packed in one field, to one row per value with its position.

1. Protect: an escaped character and everything between double quotes is moved to code points that
   no text may hold (U+FDD0..U+FDDF), so what is left of a delimiter really is one.
2. Skeleton: ordinary characters are masked out; what remains, as a sorted set of symbols, is the
   field's delimiter skeleton. There are at most ``2 ** len(SYMBOLS)`` skeletons whatever the data,
   which is the bound that allows them to be broadcast.
3. Rules are resolved once per skeleton and broadcast.
4. Extraction by position: split at the rule's delimiters, restore, strip, unquote, drop empties.

Every step is a built-in expression without backtracking over the text, so long fields are linear.

Defined results
* null, empty, blank and delimiter-only fields give no rows; a value is never null or blank;
* a JSON array is read as JSON (null and blank members are skipped, numbers become their text);
* ``| ; ； 、`` line breaks and tabs separate; a slash only with blanks on both sides; the comma only
  where nothing else does; in ``ids`` fields commas and white space always separate;
* with an odd number of double quotes they are ordinary characters;
* the code points U+FDD0..U+FDEF, which no text may hold, are left out of values;
* repeated values keep their own positions; equal repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.functions.text import WS, once, strip_ws

_WSC = WS[1:-1]
#: characters that may separate, quote or escape; their protected forms follow in the same order
_GUARDED = "\\|;；、\n\r\t,，/\" \u00a0"
_PROTECTED = "".join(chr(0xFDD0 + i) for i in range(len(_GUARDED)))
_NONE = "\ufdef"
#: symbols of a skeleton
SYMBOLS = ("|", ";", "；", "、", "\n", "\t", ",", "/", " ")
_HARD = {"|": "|", ";": ";", "；": "；", "、": "、", "\n": "\\n\\r", "\t": "\\t"}


def _protect(c: Column) -> Column:
    """Escaped and quoted delimiters out of the way; a field without quote and escape stays as it is."""
    e = c
    for ch, p in zip(_GUARDED, _PROTECTED):
        if ch not in "  ":
            e = F.replace(e, F.lit("\\" + ch), F.lit(p))
    e = F.when(c.contains("\\"), e).otherwise(c)
    quoted = F.array_join(F.transform(F.split(e, '"'), lambda s, i: F.when(i % 2 == 1, F.translate(s, _GUARDED, _PROTECTED)).otherwise(s)), '"')
    return F.when(c.contains('"') & (F.size(F.split(e, '"')) % 2 == 1), quoted).otherwise(e)


def _masked(c: Column) -> Column:
    """A protected text whose outer blanks are gone and whose separating slashes are marked."""
    body = F.translate(strip_ws(c), "\r", "\n")
    return F.when(body.contains("/"), F.regexp_replace(body, f"{_WSC_RUN}/{_WSC_RUN}", _NONE)).otherwise(body)


def _symbols(body: Column) -> Column:
    """The delimiter skeleton of a masked text: a string of its symbols in their fixed order."""
    found = [F.when(body.contains(_NONE if s == "/" else s) if s != " " else body.rlike(f"[{_WSC}]"), F.lit(s)).otherwise("") for s in SYMBOLS]
    return F.concat(*found)


_WSC_RUN = f"[{_WSC}]+"


def resolve_rules(skeletons: DataFrame) -> DataFrame:
    """(ids, skeleton) -> the regular expression that separates values in fields of that skeleton."""
    sk = F.col("skeleton")
    hard = [F.when(sk.contains(s), F.lit(cls)) for s, cls in _HARD.items()]
    cls = F.concat_ws("", *hard)
    slash = sk.contains("/")
    alts = F.concat_ws(
        "|",
        F.when(cls != "", F.concat(F.lit("["), cls, F.lit("]"))),
        F.when(slash, F.lit(f"{_WSC_RUN}/{_WSC_RUN}")),
        F.when((cls == "") & ~slash & sk.contains(","), F.lit("[,，]")),
    )
    ids = F.lit(f"[|;；、,，{_WSC}]+(?:/[{_WSC}]+)?")
    return skeletons.withColumn("rule", F.when(F.col("ids"), ids).otherwise(F.when(alts != "", alts).otherwise(_NONE)))


def every_skeleton(spark: SparkSession) -> DataFrame:
    """(ids, skeleton) of every skeleton there can be, and of JSON fields: 2 * (2 ** len(SYMBOLS) + 1) rows whatever the data."""
    bits = spark.range(2 ** len(SYMBOLS)).select(F.concat(*[F.when(F.col("id").bitwiseAND(2**i) > 0, F.lit(s)).otherwise("") for i, s in enumerate(SYMBOLS)]).alias("skeleton"))
    every = bits.unionByName(spark.range(1).select(F.lit("json").alias("skeleton")))
    return every.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("ids"), "skeleton")


def _unquoted(v: Column) -> Column:
    """A stripped part without enclosing quotes, protected characters restored."""
    inner = F.when(
        (F.length(v) >= 2) & v.startswith('"') & v.endswith('"'),
        strip_ws(F.replace(F.translate(F.substring(v, F.lit(2), F.length(v) - 2), _PROTECTED, _GUARDED), F.lit('""'), F.lit('"'))),
    )
    return F.coalesce(inner, strip_ws(F.translate(v, _PROTECTED, _GUARDED)))


def unpack_values(fields: DataFrame) -> DataFrame:
    """(field, record_id, ids, packed) -> (field, record_id, pos, val), in one pass without a shuffle."""
    own = F.when(F.col("packed").rlike("[\ufdd0-\ufdef]"), F.regexp_replace("packed", "[\ufdd0-\ufdef]", "")).otherwise(F.col("packed"))
    raw = once(fields, stripped=strip_ws(own)).where("stripped <> ''").select("field", "record_id", "ids", F.col("stripped").alias("packed"))
    p = F.col("packed")
    members = F.when(p.startswith("[") & p.endswith("]"), F.from_json(p, "array<string>"))
    d = once(raw, members=members, safe=_protect(p), marked=p.contains('"') | p.contains("\\"))
    d = once(d, body=_masked(F.col("safe")))
    d = once(d, skeleton=F.when(F.col("members").isNull(), _symbols(F.col("body"))).otherwise("json"))
    rules = resolve_rules(every_skeleton(fields.sparkSession))
    d = d.join(F.broadcast(rules), ["ids", "skeleton"])  # a fixed number of rules
    d = once(d.select("field", "record_id", "marked", "members", "safe", "rule"), parts=F.when(F.col("members").isNull(), F.transform(F.split("safe", F.col("rule")), strip_ws)).otherwise(F.transform("members", strip_ws)))
    whole = F.when(F.col("marked") & F.col("members").isNull(), F.transform("parts", _unquoted)).otherwise(F.col("parts"))
    kept = F.filter(whole, lambda v: v.isNotNull() & (v != ""))
    return d.select("field", "record_id", F.posexplode(kept).alias("pos", "val"))


def packed_fields(df: DataFrame, table: str, key: str, columns: dict[str, bool]) -> DataFrame:
    """Columns of one table as (field, record_id, ids, packed); ``columns`` maps name -> is an id field."""
    pairs = [F.struct(F.lit(f"{table}.{c}").alias("field"), F.lit(i).alias("ids"), F.col(f"`{c}`").cast("string").alias("packed")) for c, i in columns.items()]
    return df.select(F.col(f"`{key}`").alias("record_id"), F.inline(F.array(*pairs))).select("field", "record_id", "ids", "packed")
