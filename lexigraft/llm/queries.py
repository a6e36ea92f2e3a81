"""Queries of the text-corpus problems, with SQL where SQL can say the same over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.llm import chunking, confusables, encodings, leakage, mapping, scans, tokens
from lexigraft.session import table


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.split_oversized(table(spark, sf_dir, "sources"), "source_id", "text", 1000, 100)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunking.split_oversized(table(spark, sf_dir, "sources"), "source_id", "text", 1000, 100)
    return pieces.where("chunk_index = 0").select("source_id").distinct()


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "entities").select("id", "name").distinct()
    return confusables.with_form(e, "name", "form", compose=True)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.lookalike_pairs(table(spark, sf_dir, "entities"), "id", "name", "source_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "entities")
    names = (e, "id", "name", table(spark, sf_dir, "canonical_entities"), "canon_id", "canon_name", "aka", "name", 0.5)
    types = (e, "id", "entity_type", table(spark, sf_dir, "canonical_types"), "type_id", "type_name", "aka", "entity_type", 0.4)
    return mapping.map_fields([names, types]).select("id", "field", "canon_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.Scans(table(spark, sf_dir, "sources"), table(spark, sf_dir, "chunk_tasks")).found()


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.Scans(table(spark, sf_dir, "sources"), table(spark, sf_dir, "chunk_tasks")).repaired()


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.encode_column(docs, "text", os.path.join(tokens.TOKENIZERS, "byte_bpe_50k.tiktoken")).select("doc_id", "ids")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.cleaned(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.lookalike_classes(table(spark, sf_dir, "entities"), "id", "name", "source_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.garbled_hits(table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p9_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.repaired(table(spark, sf_dir, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p2_pieces": p2_pieces,
    "p4_found": p4_found,
    "p4_forms": p4_forms,
    "p4_classes": p4_classes,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_paragraphs": p6_paragraphs,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_spans": p8_spans,
    "p8_cleaned": p8_cleaned,
    "p9_found": p9_found,
    "p9_repaired": p9_repaired,
}
SQL = {"p2_found": "SELECT DISTINCT source_id FROM sources WHERE length(text) > 1000"}
