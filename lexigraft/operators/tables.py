"""Relational work on public reference dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigraft.functions.text import strip_ws


def dash_level(title: Column) -> Column:
    """Depth written as dashes: all dashes of the title count, those inside a name too."""
    return F.length(title) - F.length(F.replace(title, F.lit("-"), F.lit("")))


def leading_dash_level(title: Column) -> Column:
    """Depth by the dashes before the name only."""
    return F.length(F.regexp_replace(F.regexp_extract(title, "^[- ]*", 0), " ", ""))


def hierarchy(rows: DataFrame, order: str, level: Column, by: list[str] | None = None) -> DataFrame:
    """Rows with ``depth`` and ``parent`` title, however deep; ``rows`` has a ``title``.

    Levels may jump; a row then counts as one below the row before it. The closed form
    ``least(min over earlier rows of (level - row) + row, row - 1)`` replaces a stack. ``by`` names
    the columns that separate lists: each list is one window, so give them where there are many.
    A row's parent is the last row before it that is one level up: every row is laid beside the rows
    of its own level, as one that may be a parent, and beside those of the level above, as one that asks.
    """
    keys = [F.col(c) for c in (by or [])] or [F.lit(0)]
    w = Window.partitionBy(*keys).orderBy(order)
    r = rows.withColumn("__rn", F.row_number().over(w)).withColumn("__l", level)
    r = r.withColumn("__m", F.min(F.col("__l") - F.col("__rn")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("depth", F.least(F.col("__m") + F.col("__rn"), F.col("__rn") - 1).cast("int"))
    part = lambda at, title, asks: F.struct(at.alias("at"), title.alias("title"), F.lit(asks).alias("asks"))
    r = r.withColumn("__p", F.explode(F.array(part(F.col("depth"), F.col("title"), False), part(F.col("depth") - 1, F.lit(None).cast("string"), True))))
    above = Window.partitionBy(*keys, "__p.at").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("parent", F.last("__p.title", ignorenulls=True).over(above)).where("__p.asks")
    return r.drop("__rn", "__l", "__m", "__p")


def wide_records(pairs: DataFrame, keys: list[str] | None = None, sep: str = "||") -> DataFrame:
    """(rec, pos, key, val) to one row per record; repeated keys are joined in order.

    Without ``keys`` the columns are all keys in order of first sight (one small aggregate).
    """
    if keys is None:
        first = pairs.groupBy("key").agg(F.min(F.struct("rec", "pos")).alias("at")).orderBy("at")
        keys = [r.key for r in first.select("key").collect()]
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "val"))), lambda x: x["val"]), sep)
    one = pairs.groupBy("rec", "key").agg(joined.alias("val"))
    return one.groupBy("rec").pivot("key", keys).agg(F.first("val"))


def split_first(text: Column, sep: str) -> tuple[Column, Column]:
    """Before and after the first separator; the second is null where there is none."""
    at = F.instr(text, sep)
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text), F.when(at > 0, F.substring(text, at + len(sep), F.length(text)))


def stanza_pairs(lines: DataFrame, compat: bool = False) -> DataFrame:
    """Term stanzas as (doc, rec, pos, key, val). ``lines``: (doc, pos, line) in file order per document.

    Other stanzas are left out. ``compat`` keeps what an old converter did: lines of other stanzas
    belong to the term before them, lines before the first term are a record of their own (0), and
    the last term is missing.
    """
    w = Window.partitionBy("doc").orderBy("pos")
    head = F.col("line").rlike(r"^\[.*\]$")
    term = F.col("line") == "[Term]"
    n = lines.withColumn("rec", F.sum(F.when(term, 1).otherwise(0)).over(w))
    n = n.withColumn("in_term", F.last(F.when(head, term), ignorenulls=True).over(w)).withColumn("last", F.max("rec").over(Window.partitionBy("doc")))
    if compat:
        n = n.where("rec < last")
    else:
        n = n.where("in_term")
    key, val = split_first(F.col("line"), ": ")
    return n.where(~head & F.col("line").contains(": ")).select("doc", "rec", "pos", key.alias("key"), val.alias("val"))


def in_any(rows: DataFrame, key: str, ids: list[DataFrame]) -> DataFrame:
    """Rows whose key is in one of the one-column id tables; repeated rows stay."""
    every = ids[0].toDF(key)
    for d in ids[1:]:
        every = every.union(d.toDF(key))
    return rows.join(every.distinct(), key, "left_semi")


def names_of(rows: DataFrame, id_col: str, synonyms: str, preferred: str) -> DataFrame:
    """(id, name): first field of each ``||`` synonym, then the preferred name; repeats stay."""
    syn = rows.where(F.col(synonyms).isNotNull()).select(F.col(id_col).alias("id"), F.explode(F.split(F.col(synonyms), r"\|\|")).alias("s"))
    return syn.select("id", F.split_part("s", F.lit("|"), F.lit(1)).alias("name")).unionAll(rows.select(F.col(id_col).alias("id"), F.col(preferred).alias("name")))


def umls_ids(ids: Column) -> Column:
    """Distinct UMLS concept ids of a ``|`` packed field, sorted, each with its letter."""
    items = F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), r"\|"), strip_ws), lambda x: x.contains("UMLS"))
    def one(x: Column) -> Column:
        a = F.nullif(F.regexp_extract(x, r":(C\p{Nd}+)", 1), F.lit(""))
        b = F.nullif(F.regexp_extract(x, r"UMLS:(C?\p{Nd}+)", 1), F.lit(""))
        return F.coalesce(a, F.when(b.startswith("C"), b).otherwise(F.concat(F.lit("C"), b)))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(items, one))))


def grouped_ids(rows: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, ids map<source, array<id>>): ``source:id`` items of a ``|`` packed field, in field order."""
    items = rows.select(key, F.posexplode(F.split(F.col(ids), r"\|")).alias("pos", "item")).withColumn("item", strip_ws(F.col("item"))).where(F.col("item").contains(":"))
    a, b = split_first(F.col("item"), ":")
    g = items.select(key, "pos", strip_ws(a).alias("s"), strip_ws(b).alias("v")).groupBy(key, "s").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("v"))
    return g.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("s", "v")))).alias("ids"))


def clean_aliases(aliases: Column) -> Column:
    """``|`` packed names stripped, empties dropped, joined again; null stays null."""
    return F.array_join(F.filter(F.transform(F.split(aliases, r"\|"), strip_ws), lambda x: x != ""), "|")


def keep_columns(df: DataFrame, wanted: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """The wanted columns that are there, after renaming those whose new name is not."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df.select(*[c for c in wanted if c in df.columns])


def tree_numbers(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """(tree): distinct tree numbers below a prefix, the prefix and its dot removed wherever they occur."""
    t = rows.where(F.col(column).isNotNull() & F.col(column).rlike(prefix)).select(F.explode(F.split(F.col(column), r"\|\|")).alias("tree"))
    return t.where(F.col("tree").startswith(prefix)).select(F.replace("tree", F.lit(prefix + "."), F.lit("")).alias("tree")).distinct()


def tree_stats(trees: DataFrame) -> DataFrame:
    """One row: roots, classes, leaves, max_depth, avg_leaf_depth, avg_width, fan_out.

    A node's parent drops its last four characters; depth is the number of dotted parts; the longest
    number gives the maximum.
    """
    depth = F.size(F.split("tree", r"\."))
    parent = F.substring(F.col("tree"), F.lit(1), F.greatest(F.length("tree") - 4, F.lit(0)))
    t = trees.select("tree", depth.alias("d"), parent.alias("parent"))
    leaves = t.join(t.select(F.col("parent").alias("tree")).distinct(), "tree", "left_anti").agg(F.count("*").alias("leaves"), F.avg("d").alias("avg_leaf_depth"))
    fan = t.where("parent <> ''").agg((F.count("*") / F.nullif(F.count_distinct("parent"), F.lit(0))).alias("fan_out"))
    a = t.agg(
        F.count_if(F.length("tree") == 3).alias("roots"), F.count("*").alias("classes"), F.max_by("d", F.struct(F.length("tree"), "tree")).alias("max_depth"),
        (F.count("*") / F.nullif(F.count_distinct("d"), F.lit(0))).alias("avg_width"),
    )
    return a.crossJoin(leaves).crossJoin(fan)  # three single rows


def synonym_count(rows: DataFrame, column: str) -> DataFrame:
    """One row: distinct first fields of ``||`` packed entries."""
    s = rows.where(F.col(column).isNotNull()).select(F.explode(F.split(F.col(column), r"\|\|")).alias("s"))
    return s.agg(F.count_distinct(F.split_part("s", F.lit("|"), F.lit(1))).alias("synonyms"))


def _counted(c: Column) -> Column:
    """A list wrapper's declared count, 0 where missing."""
    return F.coalesce(F.expr("0") + c.try_cast("int"), F.lit(0)) if hasattr(c, "try_cast") else F.coalesce(c.cast("int"), F.lit(0))


def flat_disorders(rows: DataFrame) -> DataFrame:
    """(id, orphaCode, disease_name, external_id_ls, synonym_ls, summary_ls) of nested disorders.

    First wrapper of each list, read only where its declared count is positive; pairs are joined with
    a colon, values with a bar. Values are sorted and distinct, so the result does not depend on order.
    """
    get = lambda c: F.get(F.col(c), F.lit(0))
    ext, syn, summ = get("ExternalReferenceList"), get("SynonymList"), get("SummaryInformationList")
    listed = lambda w, items: F.when(_counted(w["count"]) > 0, items)
    tidy = lambda a: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.array_compact(a))), "|"), F.lit(""))
    e = listed(ext, F.transform(ext["ExternalReference"], lambda x: F.concat(x["Source"], F.lit(":"), x["Reference"])))
    s = listed(syn, F.transform(syn["Synonym"], lambda x: x["label"]))
    def first(x: Column) -> Column:
        w = F.get(x["TextSectionList"], F.lit(0))
        t = F.get(w["TextSection"], F.lit(0))
        label = F.get(F.get(t["TextSectionType"], F.lit(0))["Name"], F.lit(0))["label"]
        return F.when(_counted(w["count"]) > 0, F.concat(label, F.lit(":"), t["Contents"]))
    m = listed(summ, F.transform(summ["SummaryInformation"], first))
    return rows.select("id", F.col("OrphaCode").alias("orphaCode"), get("Name")["label"].alias("disease_name"), tidy(e).alias("external_id_ls"), tidy(s).alias("synonym_ls"), tidy(m).alias("summary_ls"))


def chinese_synonyms(rows: DataFrame) -> DataFrame:
    """(id, synonym_ls) with the synonyms marked as Chinese only."""
    syn = F.get(F.col("SynonymList"), F.lit(0))
    zh = F.transform(F.filter(syn["Synonym"], lambda x: x["lang"] == "zh"), lambda x: x["label"])
    return rows.select("id", F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.array_compact(zh))), "|"), F.lit("")).alias("synonym_ls"))
