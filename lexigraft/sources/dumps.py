"""Readers of public reference dumps, as DataFrames with declared schemas where there are any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.operators.tables import split_first, stanza_pairs, wide_records

MALACARDS = "McId string, DiseaseName string, DiseaseSlug string, Aliases string, ExternalIds string"
GENES = ["McId", "DiseaseName", "DiseaseSlug", "GeneSymbol", "isElite", "isCancerCensus", "GeneDisorderScore", "Implications", "Publications"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc, pos, line): files are read whole so that positions are known; one row per file first."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), F.split(F.regexp_replace("value", "\r", ""), "\n").alias("ls"))
    return t.select("doc", F.posexplode("ls").alias("pos", "line"))


def read_obo(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """One row per term of each file, repeated keys joined with ``||``.

    The reader splits at the head of a stanza, so a large file is many tasks. ``compat`` (see
    ``stanza_pairs``) needs every file in order and reads it whole.
    """
    if compat:
        p = stanza_pairs(_lines(spark, path), True)
        return wide_records(p.select(F.struct("doc", "rec").alias("rec"), "pos", "key", "val")).drop("rec")
    r = spark.read.option("lineSep", "\n[").text(path).withColumn("rec", F.monotonically_increasing_id())
    ls = F.split(F.regexp_replace("value", "\r", ""), "\n")
    terms = r.select("rec", F.posexplode(ls).alias("pos", "line"), F.ltrim(F.get(ls, F.lit(0)), F.lit("[")).alias("head")).where("head = 'Term]' and pos > 0")
    k, v = split_first(F.col("line"), ": ")
    return wide_records(terms.where(F.col("line").contains(": ")).select("rec", "pos", k.alias("key"), v.alias("val"))).drop("rec")


def read_mesh(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``*NEWRECORD`` block of ``KEY = value`` lines; the reader itself splits at the marker."""
    r = spark.read.option("lineSep", "*NEWRECORD").text(path).withColumn("rec", F.monotonically_increasing_id())
    lines = r.select("rec", F.posexplode(F.split(F.regexp_replace("value", "\r", ""), "\n")).alias("pos", "line")).where(F.col("line").contains(" = "))
    k, v = split_first(F.col("line"), " = ")
    return wide_records(lines.select("rec", "pos", k.alias("key"), v.alias("val"))).drop("rec")


def read_table(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """Delimited text with a header; all columns are strings unless a schema is given."""
    r = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", sep == ",")
    return (r.schema(schema) if schema else r.option("inferSchema", False)).csv(path)


def read_malacards(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MALACARDS, "\t")


def read_titles(spark: SparkSession, path: str, order: str = "ord") -> DataFrame:
    """(ord, title) of a classification's first column, as CSV (spreadsheets are to be saved as CSV); ``ord`` rises in file order."""
    t = read_table(spark, path)
    return t.select(F.monotonically_increasing_id().alias(order), F.col(f"`{t.columns[0]}`").alias("title")).where("title <> ''")


def read_drugs(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, description, synonyms): first id of each top-level drug; distinct rows."""
    syn = "synonyms struct<synonym: array<string>>"
    x = spark.read.format("xml").option("rowTag", "drug").schema(f"`drugbank-id` array<string>, name string, description string, {syn}").load(path)
    names = F.array_join(F.array_sort(F.array_distinct(F.coalesce("synonyms.synonym", F.array().cast("array<string>")))), "||")
    return x.select(F.get("drugbank-id", F.lit(0)).alias("id"), "name", "description", names.alias("synonyms")).where("id is not null").distinct()


def read_disorder_genes(spark: SparkSession, path: str, charset: str = "ISO-8859-1") -> DataFrame:
    """(orpha_code, gene_symbol), one row per association."""
    schema = "OrphaCode string, DisorderGeneAssociationList struct<DisorderGeneAssociation: array<struct<Gene: struct<Symbol: string>>>>"
    x = spark.read.format("xml").option("rowTag", "Disorder").option("charset", charset).schema(schema).load(path)
    g = x.select(F.col("OrphaCode").alias("orpha_code"), F.explode("DisorderGeneAssociationList.DisorderGeneAssociation").alias("a"))
    return g.select("orpha_code", F.col("a.Gene.Symbol").alias("gene_symbol"))


def read_disorders(spark: SparkSession, path: str) -> DataFrame:
    """The nested disorder records of the JSON dump."""
    return disorders_of(spark.read.option("multiLine", True).json(path))


def disorders_of(j: DataFrame) -> DataFrame:
    """The nested disorder records of parsed dumps."""
    return j.select(F.explode(F.get(F.get("JDBOR", F.lit(0))["DisorderList"], F.lit(0))["Disorder"]).alias("d")).select("d.*")
