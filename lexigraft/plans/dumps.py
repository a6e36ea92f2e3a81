"""Queries of reference-dump operators, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexigraft.operators import tables as t
from lexigraft.plans.text import _STRIP
from lexigraft.session import shared_dir, table
from lexigraft.streaming.ingest import stream_table


def _titles(spark, d):
    p = table(spark, d, "part")
    return p.select("p_brand", "p_partkey", F.concat(F.repeat(F.lit("- "), F.col("p_size") % 6), "p_name").alias("title"))


_TITLES = "(SELECT p_brand, p_partkey, repeat('- ', CAST(p_size % 6 AS INTEGER)) || p_name title FROM part)"


def hierarchy(spark, d):
    return t.hierarchy(_titles(spark, d), "p_partkey", t.dash_level(F.col("title")), by=["p_brand"]).select("p_partkey", F.btrim("title", F.lit("- ")).alias("title"), "depth", F.btrim("parent", F.lit("- ")).alias("parent"))


_HIERARCHY = f"""
WITH r AS (SELECT *, row_number() OVER w rn, length(title) - length(replace(title, '-', '')) l FROM {_TITLES} WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)),
m AS (SELECT *, CAST(least(min(l - rn) OVER (PARTITION BY p_brand ORDER BY rn) + rn, rn - 1) AS INTEGER) depth FROM r),
j AS (SELECT a.p_partkey, arg_max(b.title, b.rn) parent FROM m a JOIN m b ON a.p_brand = b.p_brand AND b.rn < a.rn AND b.depth = a.depth - 1 GROUP BY 1)
SELECT m.p_partkey, trim(title, '- ') title, depth, trim(parent, '- ') parent FROM m LEFT JOIN j USING (p_partkey)
"""


def kv_pivot(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("rec"), F.col("event_id").alias("pos"), F.col("event_type").alias("key"), F.col("event_id").cast("string").alias("val"))
    return t.wide_records(e, sorted(r.key for r in e.select("key").distinct().collect()))  # a handful of event types


def stanzas(spark, d):
    p = table(spark, d, "part")
    line = F.when(F.col("p_partkey") % 5 == 1, "[Term]").when(F.col("p_partkey") % 35 == 3, "[Typedef]").otherwise(F.concat_ws(": ", "p_type", "p_name"))
    return t.stanza_pairs(p.select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("pos"), line.alias("line")))


_STANZAS = """
WITH l AS (SELECT p_brand doc, p_partkey pos, CASE WHEN p_partkey % 5 = 1 THEN '[Term]' WHEN p_partkey % 35 = 3 THEN '[Typedef]' ELSE concat_ws(': ', p_type, p_name) END line FROM part),
s AS (SELECT *, sum(CASE WHEN line = '[Term]' THEN 1 ELSE 0 END) OVER w rec, last_value(CASE WHEN line LIKE '[%]' THEN line END IGNORE NULLS) OVER w st FROM l WINDOW w AS (PARTITION BY doc ORDER BY pos))
SELECT doc, CAST(rec AS BIGINT) rec, pos, split_part(line, ': ', 1) "key", substring(line, strpos(line, ': ') + 2) val FROM s WHERE st = '[Term]' AND line NOT LIKE '[%]' AND line LIKE '%: %'
"""


def semi_ids(spark, d):
    c, s, n = (table(spark, d, x) for x in ("customer", "supplier", "nation"))
    return t.in_any(n.select(F.col("n_nationkey").alias("k"), "n_name"), "k", [c.where("c_acctbal > 5000").select("c_nationkey"), s.where("s_acctbal < 0").select("s_nationkey"), n.where("n_regionkey = 1").select("n_nationkey")])


_SEMI = "SELECT n_nationkey k, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 5000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal < 0 UNION SELECT n_nationkey FROM nation WHERE n_regionkey = 1)"


def _mesh(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("UI"), F.col("p_name").alias("MH"), F.when(F.col("p_size") % 4 > 0, F.concat(F.replace("p_name", F.lit(" "), F.lit("|T1||")), F.lit("|"), "p_type")).alias("ENTRY"))


def synonyms(spark, d):
    return t.names_of(_mesh(spark, d), "UI", "ENTRY", "MH")


_SYN = """WITH m AS (SELECT p_partkey UI, p_name MH, CASE WHEN p_size % 4 > 0 THEN replace(p_name, ' ', '|T1||') || '|' || p_type END e FROM part)
SELECT UI id, split_part(s, '|', 1) "name" FROM (SELECT UI, unnest(string_split(e, '||')) s FROM m WHERE e IS NOT NULL) UNION ALL SELECT UI, MH FROM m"""


def synonym_count(spark, d):
    return t.synonym_count(_mesh(spark, d), "ENTRY")


def _diseases(spark, d):
    return table(spark, d, "disease").select("McId", "DiseaseName", "DiseaseSlug", "Aliases", "ExternalIds").distinct()


_D = "(SELECT DISTINCT McId, DiseaseName, DiseaseSlug, Aliases, ExternalIds FROM disease)"


def cuis(spark, d):
    return _diseases(spark, d).select("McId", F.explode(t.umls_ids(F.col("ExternalIds"))).alias("CUI")).dropDuplicates(["McId", "CUI"])


_CUIS = rf"""WITH i AS (SELECT McId, {_STRIP('x')} x FROM (SELECT McId, unnest(string_split(ExternalIds, '|')) x FROM {_D}) WHERE x LIKE '%UMLS%'),
c AS (SELECT McId, nullif(regexp_extract(x, ':(C\p{{Nd}}+)', 1), '') a, nullif(regexp_extract(x, 'UMLS:(C?\p{{Nd}}+)', 1), '') b FROM i)
SELECT DISTINCT McId, coalesce(a, CASE WHEN b LIKE 'C%' THEN b ELSE 'C' || b END) "CUI" FROM c WHERE a IS NOT NULL OR b IS NOT NULL"""


def external_ids(spark, d):
    g = t.grouped_ids(_diseases(spark, d), "McId", "ExternalIds")
    return g.select("McId", F.explode("ids").alias("source", "l")).select("McId", "source", F.array_join("l", ",").alias("ids"))


_EXT = f"""WITH i AS (SELECT McId, unnest(l) x, generate_subscripts(l, 1) n FROM (SELECT McId, string_split(ExternalIds, '|') l FROM {_D})),
s AS (SELECT McId, n, {_STRIP('x')} x FROM i WHERE x LIKE '%:%')
SELECT McId, {_STRIP("substring(x, 1, strpos(x, ':') - 1)")} source, string_agg({_STRIP("substring(x, strpos(x, ':') + 1)")}, ',' ORDER BY n) ids FROM s GROUP BY 1, 2"""


def aliases(spark, d):
    return t.keep_columns(_diseases(spark, d).withColumn("Aliases", t.clean_aliases(F.col("Aliases"))).withColumnRenamed("McId", "MCId"), ["McId", "DiseaseName", "Aliases", "GeneSymbol"], {"MCId": "McId"})


_ALIASES = f"""SELECT McId, DiseaseName, array_to_string(list_filter(list_transform(string_split(Aliases, '|'), lambda x: {_STRIP('x')}), lambda x: x <> ''), '|') "Aliases" FROM {_D}"""


def _trees(spark, d):
    s = table(spark, d, "supplier")
    mn = F.concat(F.lit("C23.888."), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("."), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0"))).otherwise(""), F.when(F.col("s_suppkey") % 2 > 0, "||A01.100").otherwise(""))
    return s.select(mn.alias("MN"))


def tree_stats(spark, d):
    r = t.tree_stats(t.tree_numbers(_trees(spark, d), "MN", "C23.888"))
    return r.select("roots", "classes", "leaves", "max_depth", *[F.round(c, 6).alias(c) for c in ("avg_leaf_depth", "avg_width", "fan_out")])


_TREES = """
WITH s AS (SELECT 'C23.888.' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') || CASE WHEN s_suppkey % 3 > 0 THEN '.' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') ELSE '' END tree FROM supplier),
t AS (SELECT DISTINCT replace(tree, 'C23.888.', '') tree FROM s), u AS (SELECT tree, len(string_split(tree, '.')) d, left(tree, greatest(length(tree) - 4, 0)) p FROM t),
l AS (SELECT * FROM u WHERE tree NOT IN (SELECT p FROM u))
SELECT (SELECT count(*) FROM u WHERE length(tree) = 3) roots, (SELECT count(*) FROM u) classes, (SELECT count(*) FROM l) leaves, (SELECT CAST(arg_max(d, length(tree)) AS INTEGER) FROM u) max_depth,
 (SELECT round(avg(d), 6) FROM l) avg_leaf_depth, (SELECT round(count(*) / count(DISTINCT d), 6) FROM u) avg_width, (SELECT round(count(*) / count(DISTINCT p), 6) FROM u WHERE p <> '') fan_out
"""


def _nested(spark, d):
    return table(spark, d, "disease_alignment_en").drop("loaded_at").distinct()


def disorders(spark, d):
    return t.flat_disorders(_nested(spark, d))


_N = "(SELECT DISTINCT id, OrphaCode, Name, ExternalReferenceList, SynonymList, SummaryInformationList FROM disease_alignment_en)"
_J = lambda x: f"coalesce(array_to_string(list_sort(list_distinct(list_filter({x}, lambda y: y IS NOT NULL))), '|'), '')"
_C = lambda w: f"coalesce(TRY_CAST({w}.count AS INTEGER), 0) > 0"
_DISORDERS = f"""
WITH d AS (SELECT id, OrphaCode, Name[1].label n, ExternalReferenceList[1] e, SynonymList[1] s, SummaryInformationList[1] m FROM {_N})
SELECT id, OrphaCode "orphaCode", n disease_name,
 CASE WHEN {_C('e')} THEN {_J("list_transform(e.ExternalReference, lambda x: x.Source || ':' || x.Reference)")} ELSE '' END external_id_ls,
 CASE WHEN {_C('s')} THEN {_J("list_transform(s.Synonym, lambda x: x.label)")} ELSE '' END synonym_ls,
 CASE WHEN {_C('m')} THEN {_J("list_transform(m.SummaryInformation, lambda x: CASE WHEN coalesce(TRY_CAST(x.TextSectionList[1].count AS INTEGER), 0) > 0 THEN x.TextSectionList[1].TextSection[1].TextSectionType[1].Name[1].label || ':' || x.TextSectionList[1].TextSection[1].Contents END)")} ELSE '' END summary_ls
FROM d
"""


def marked_synonyms(spark, d):
    return t.chinese_synonyms(_nested(spark, d))


def distinct_drugs(spark, d):
    return table(spark, d, "entities").select("name", "entity_type", "source_id", F.lit("drug").alias("kind")).where("entity_type = 'drug'").distinct()


def stream_sources(spark, d):
    """The sources table read as a stream, each source kept once, written and read back."""
    at = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    s = stream_table(spark, f"{d}/sources.parque[t]", table(spark, d, "sources").schema).select("source_id", "source_name", F.length("text").alias("n")).dropDuplicates(["source_id"])
    q = s.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{at}/out")


QUERIES = {
    "hierarchy": hierarchy, "kv_pivot": kv_pivot, "stanza_pairs": stanzas, "semi_ids": semi_ids, "synonyms_union": synonyms, "synonym_count": synonym_count, "cui_extract": cuis, "external_ids": external_ids,
    "disease_aliases": aliases, "tree_stats": tree_stats, "flat_disorders": disorders, "chinese_synonyms": marked_synonyms, "distinct_drugs": distinct_drugs, "stream_sources": stream_sources,
}
_KV = "SELECT user_id rec, " + ", ".join(f"string_agg(CAST(event_id AS VARCHAR), '||' ORDER BY event_id) FILTER (event_type = '{k}') \"{k}\"" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1"
SQL = {
    "hierarchy": _HIERARCHY, "kv_pivot": _KV, "stanza_pairs": _STANZAS, "semi_ids": _SEMI, "synonyms_union": _SYN,
    "synonym_count": "SELECT count(DISTINCT split_part(s, '|', 1)) synonyms FROM (SELECT unnest(string_split(replace(p_name, ' ', '|T1||') || '|' || p_type, '||')) s FROM part WHERE p_size % 4 > 0)",
    "cui_extract": _CUIS, "external_ids": _EXT, "disease_aliases": _ALIASES, "tree_stats": _TREES, "flat_disorders": _DISORDERS,
    "chinese_synonyms": f"SELECT id, coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(SynonymList[1].Synonym, lambda x: x.lang = 'zh'), lambda x: x.label))), '|'), '') synonym_ls FROM {_N}",
    "distinct_drugs": "SELECT DISTINCT name, entity_type, source_id, 'drug' kind FROM entities WHERE entity_type = 'drug'",
    "stream_sources": "SELECT DISTINCT source_id, source_name, length(text) n FROM sources",
}
