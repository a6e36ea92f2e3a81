"""Joining drafts with independent reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def review_key(name: Column, context: Column) -> Column:
    return F.sha2(F.concat(name, F.lit("\0"), context), 256)


def pending_requests(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """(name, context, ord, value): requests that no cached review answers, one per (name, context).

    Of repeated requests the last value and the first place count.
    """
    w = Window.partitionBy("name", "context")
    one = requests.withColumn("rn", F.row_number().over(w.orderBy(F.col("ord").desc()))).withColumn("first", F.min("ord").over(w)).where("rn = 1")
    missing = one.join(cache.select("name", "context"), ["name", "context"], "left_anti")
    return missing.select("name", "context", F.col("first").alias("ord"), "value")


def batches_of(rows: DataFrame, size: int = 5, order: str = "ord", by: str = "source_id") -> DataFrame:
    """Adds ``batch``: consecutive groups of ``size`` within each source."""
    rn = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return rows.withColumn("batch", F.floor((rn - 1) / size).cast("int"))


def apply_reviews(entities: DataFrame, reviews: DataFrame) -> DataFrame:
    """Entities with ``kind`` of warning: entity_type, entity_not_extractable, entity_type_review_missing, or null.

    ``reviews``: (source_id, name, should_extract, recommended_entity_type, confidence).
    """
    r = entities.join(reviews.withColumn("__r", F.lit(True)), ["source_id", "name"], "left")
    same = F.col("should_extract") & F.col("recommended_entity_type").eqNullSafe(F.col("entity_type"))
    kind = F.when(F.col("__r").isNull(), "entity_type_review_missing").when(~F.col("should_extract"), "entity_not_extractable").when(~same, "entity_type")
    return r.withColumn("consistent", F.coalesce(same, F.lit(False))).withColumn("kind", kind).drop("__r")


def review_summary(reviewed: DataFrame) -> DataFrame:
    """Per source: reviewed, inconsistent and not extractable counts, and the latter's names in order."""
    seen = F.col("kind").isNull() | (F.col("kind") != "entity_type_review_missing")
    off = F.col("kind") == "entity_not_extractable"
    return reviewed.groupBy("source_id").agg(
        F.count_if(seen).alias("reviewed"),
        F.count_if(seen & ~F.col("consistent")).alias("inconsistent"),
        F.count_if(off).alias("not_extractable"),
        F.transform(F.sort_array(F.collect_list(F.when(off, F.struct("ord", "name")))), lambda x: x["name"]).alias("not_extractable_names"),
    )


def local_context(text: Column, name: Column, radius: int = 160) -> Column:
    """Text around the first three hits of a name, or the first hit of each member of a group.

    Equal pieces count once, pieces are joined in text order; no hit gives an empty text.
    """
    n = F.length(name)
    p1 = F.locate(name, text) if isinstance(name, str) else F.instr(text, name)
    after = lambda p: F.when(p > 0, F.position(name, text, p + n)).otherwise(0)
    p2 = after(p1)
    p3 = after(p2)
    piece = lambda p, k: F.substring(text, F.greatest(p - radius, F.lit(1)), k + radius + F.least(p - 1, F.lit(radius)))
    whole = F.array_compact(F.array(*[F.when(p > 0, piece(p, n)) for p in (p1, p2, p3)]))
    members = F.filter(F.split(name, r"\|"), lambda m: m != "")
    hits = F.sort_array(F.filter(F.transform(members, lambda m: F.struct(F.instr(text, m).alias("p"), F.length(m).alias("k"))), lambda h: h["p"] > 0))
    parts = F.transform(hits, lambda h: piece(h["p"], h["k"]))
    chosen = F.when(name.contains("|") & ~text.contains(name) & (F.size(members) > 1), parts).otherwise(whole)
    return F.array_join(F.array_distinct(chosen), "\n…\n")
