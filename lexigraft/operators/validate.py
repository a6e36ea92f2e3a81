"""Checks of draft graphs, as rows of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigraft.functions.text import is_blank

ISSUE = ["source_id", "code", "item_id", "ord"]


def repeated(*key: str, order: str = "ord") -> Column:
    """True on every row of a key but the first."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(order)) > 1


def entity_issues(entities: DataFrame, types: DataFrame, evidence: Column | None = None) -> DataFrame:
    """EMPTY_NAME, UNKNOWN_ENTITY_TYPE, INVALID_ENTITY_EVIDENCE, DUPLICATE_ENTITY.

    ``entities``: (source_id, ord, item_id, name, entity_type, ...); ``types``: (entity_type), small;
    ``evidence``: boolean, true where the text does not support the name. One window over
    (source_id, name, type) is the only shuffle.
    """
    known = types.select("entity_type").distinct().withColumn("__known", F.lit(True))
    e = entities.join(known, "entity_type", "left").withColumn("__again", repeated("source_id", "name", "entity_type"))
    codes = [F.when(is_blank(F.col("name")), "EMPTY_NAME"), F.when(F.col("__known").isNull(), "UNKNOWN_ENTITY_TYPE")]
    if evidence is not None:
        codes.append(F.when(evidence, "INVALID_ENTITY_EVIDENCE"))
    codes.append(F.when(F.col("__again"), "DUPLICATE_ENTITY"))
    return e.select("source_id", F.explode(F.array_compact(F.array(*codes))).alias("code"), "item_id", "ord")


def relation_issues(relations: DataFrame, entities: DataFrame, rules: DataFrame) -> DataFrame:
    """MISSING_RELATION_ENTITY, or UNKNOWN_RELATION_TYPE / RELATION_TYPE_MISMATCH, and DUPLICATE_RELATION.

    ``relations``: (source_id, ord, item_id, subject_id, relation_type, object_id); ``entities``:
    (source_id, item_id, entity_type); ``rules``: (relation_type, head_type, tail_type), small. Rows
    with a missing end take no part in the search for repeats.
    """
    ends = entities.select("source_id", "item_id", "entity_type")
    s = ends.select("source_id", F.col("item_id").alias("subject_id"), F.col("entity_type").alias("head_type"), F.lit(True).alias("__s"))
    o = ends.select("source_id", F.col("item_id").alias("object_id"), F.col("entity_type").alias("tail_type"), F.lit(True).alias("__o"))
    r = relations.join(s, ["source_id", "subject_id"], "left").join(o, ["source_id", "object_id"], "left")
    r = r.join(rules.select("relation_type").distinct().withColumn("__rule", F.lit(True)), "relation_type", "left")
    r = r.join(rules.distinct().withColumn("__fits", F.lit(True)), ["relation_type", "head_type", "tail_type"], "left")
    lost = F.col("__s").isNull() | F.col("__o").isNull()
    r = r.withColumn("__lost", lost)
    again = F.row_number().over(Window.partitionBy("source_id", "subject_id", "relation_type", "object_id", "__lost").orderBy("ord")) > 1
    r = r.withColumn("__again", again)
    codes = F.when(F.col("__lost"), F.array(F.lit("MISSING_RELATION_ENTITY"))).otherwise(
        F.array_compact(
            F.array(
                F.when(F.col("__rule").isNull(), "UNKNOWN_RELATION_TYPE").when(F.col("__fits").isNull(), "RELATION_TYPE_MISMATCH"),
                F.when(F.col("__again"), "DUPLICATE_RELATION"),
            )
        )
    )
    return r.select("source_id", F.explode(codes).alias("code"), "item_id", "ord")


def submit_gate(warnings: Column, committed: Column, revision: Column, validated: Column, entities: Column, empty_confirmed: Column, issues: Column) -> Column:
    """The outcome of a submission, first failing check first."""
    return (
        F.when(committed, "already_committed")
        .when(warnings > 0, "REVIEW_WARNINGS_PENDING")
        .when(~validated.eqNullSafe(revision), "CHUNK_NOT_VALIDATED")
        .when((entities == 0) & ~empty_confirmed.eqNullSafe(revision), "EMPTY_CHUNK_NOT_CONFIRMED")
        .when(issues > 0, "VALIDATION_FAILED")
        .otherwise("committed")
    )
