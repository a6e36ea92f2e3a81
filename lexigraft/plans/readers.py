"""Queries of the dump readers: the tables are written in each dump's format and read back, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.session import scratch, table
from lexigraft.sources import dumps


def _written(rows: DataFrame, text: Column) -> str:
    """Text files of one entry per row, in a folder all executors share."""
    at = scratch(rows.sparkSession)
    rows.select(text.alias("value")).write.text(at)
    return at


def _documents(rows: DataFrame, root: str, entry: Column) -> str:
    """XML files of a root element with many entries each."""
    part = rows.select(entry.alias("e"), F.spark_partition_id().alias("p"), F.floor(F.rand(1) * 8).alias("q"))
    text = F.concat(F.lit(f"<{root}>\n"), F.array_join(F.collect_list("e"), "\n"), F.lit(f"\n</{root}>"))
    at = scratch(rows.sparkSession)
    part.groupBy("p", "q").agg(text.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(at)
    return at


def _one_line(c: str) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\n\r]", " ")


def obo_terms(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    head = F.when(F.col("p_partkey") % 7 == 3, F.lit("[Typedef]")).otherwise("[Term]")
    entry = F.concat(F.lit("\n"), head, F.lit("\nid: P:"), F.col("p_partkey"), F.lit("\nname: "), F.col("p_name"), F.lit("\nsynonym: "), F.col("p_type"), F.lit("\nsynonym: "), F.col("p_brand"), F.lit("\n"))
    return dumps.read_obo(spark, _written(p, entry)).select("id", "name", "synonym")


_OBO = "SELECT concat('P:', p_partkey) id, p_name AS name, concat(p_type, '||', p_brand) synonym FROM part WHERE p_partkey % 7 <> 3"


def mesh_records(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    entry = F.concat(F.lit("*NEWRECORD\nRECTYPE = D\nMH = "), F.col("p_name"), F.lit("\nENTRY = "), F.col("p_type"), F.lit("\nENTRY = "), F.col("p_brand"), F.lit("\nUI = D"), F.col("p_partkey"), F.lit("\n"))
    return dumps.read_mesh(spark, _written(p, entry)).select("MH", "ENTRY", "UI")


_MESH = """SELECT p_name "MH", concat(p_type, '||', p_brand) "ENTRY", concat('D', p_partkey) "UI" FROM part"""


def malacards_rows(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "disease").select("McId", *[_one_line(x).alias(x) for x in ("DiseaseName", "DiseaseSlug", "Aliases", "ExternalIds")]).distinct()
    at = scratch(spark)
    c.write.option("header", True).option("sep", "\t").option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(at)
    return dumps.read_malacards(spark, at).select("McId", F.coalesce("DiseaseName", F.lit("")).alias("name"), F.length(F.coalesce("Aliases", F.lit(""))).alias("aliases"))


_MALA = r"""
WITH d AS (SELECT DISTINCT McId, regexp_replace(coalesce(DiseaseName, ''), '[\n\r]', ' ', 'g') "name", regexp_replace(coalesce(DiseaseSlug, ''), '[\n\r]', ' ', 'g') s,
  regexp_replace(coalesce(Aliases, ''), '[\n\r]', ' ', 'g') a, regexp_replace(coalesce(ExternalIds, ''), '[\n\r]', ' ', 'g') e FROM disease)
SELECT McId, "name", CAST(length(a) AS INTEGER) aliases FROM d
"""


def drug_rows(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), c, F.lit(f"</{n}>"))
    ids = F.concat(tag("drugbank-id", F.concat(F.lit("DB"), F.col("s_suppkey"))), tag("drugbank-id", F.concat(F.lit("OLD"), F.col("s_suppkey"))))
    syn = tag("synonyms", F.concat(tag("synonym", F.concat(F.lit("z"), F.col("s_nationkey"))), tag("synonym", F.concat(F.lit("a"), F.col("s_suppkey")))))
    return dumps.read_drugs(spark, _documents(s, "drugs", tag("drug", F.concat(ids, tag("name", F.col("s_name")), tag("description", F.lit("made")), syn))))


_DRUGS = "SELECT concat('DB', s_suppkey) id, s_name AS name, 'made' description, concat('a', s_suppkey, '||z', s_nationkey) synonyms FROM supplier"


def gene_rows(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    gene = lambda c: F.concat(F.lit("<DisorderGeneAssociation><Gene><Symbol>"), c, F.lit("</Symbol></Gene></DisorderGeneAssociation>"))
    genes = F.concat(gene(F.concat(F.lit("G"), F.col("s_nationkey"))), gene(F.concat(F.lit("H"), F.col("s_suppkey"))))
    entry = F.concat(F.lit("<Disorder><OrphaCode>"), F.col("s_suppkey"), F.lit("</OrphaCode><DisorderGeneAssociationList>"), genes, F.lit("</DisorderGeneAssociationList></Disorder>"))
    return dumps.read_disorder_genes(spark, _documents(s, "list", entry), "UTF-8")


_GENES = "SELECT CAST(s_suppkey AS VARCHAR) orpha_code, unnest([concat('G', s_nationkey), concat('H', s_suppkey)]) gene_symbol FROM supplier"


def title_rows(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.concat_ws(", ", "p_brand", "p_name").alias("title"), "p_partkey")
    at = scratch(spark)
    p.write.option("header", True).option("escape", '"').csv(at)
    return dumps.read_titles(spark, at).select("title")


_TITLES = "SELECT concat(p_brand, ', ', p_name) title FROM part"


def disorder_records(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "disease_alignment_en").select("id", "OrphaCode", "Name")
    entry = F.concat(F.lit('{"JDBOR":[{"DisorderList":[{"Disorder":['), F.to_json(F.struct("id", "OrphaCode", "Name")), F.lit("]}]}]}"))
    at = scratch(spark)
    a.select(entry.alias("value")).repartition(8).write.text(at)
    # one document per line here: each line is a dump of its own
    j = dumps.disorders_of(spark.read.json(at))
    return j.select("id", F.get("Name", F.lit(0))["label"].alias("label"))


_DISORDERS = "SELECT id, Name[1].label AS label FROM disease_alignment_en"

QUERIES = {"obo_terms": obo_terms, "mesh_records": mesh_records, "malacards_rows": malacards_rows, "drug_rows": drug_rows, "gene_rows": gene_rows, "title_rows": title_rows, "disorder_records": disorder_records}
SQL = {"obo_terms": _OBO, "mesh_records": _MESH, "malacards_rows": _MALA, "drug_rows": _DRUGS, "gene_rows": _GENES, "title_rows": _TITLES, "disorder_records": _DISORDERS}
