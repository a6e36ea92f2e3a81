"""Counts over runs, drafts and reviews, and results grouped per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_summary(chunks: DataFrame) -> DataFrame:
    """One row of counts by status; whatever is not stored is incomplete, failures included. ``chunks``: (file, status)."""
    s = F.col("status")
    return chunks.agg(
        F.count_distinct("file").alias("files"),
        F.count("*").alias("chunks"),
        F.count_if(s == "committed").alias("committed"),
        F.count_if(s == "already_committed").alias("skipped"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(~s.isin("committed", "already_committed")).alias("incomplete"),
    )


def workspace_summary(sources: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(source_id, entity_count, relation_count), zero where there are none."""
    e = entities.groupBy("source_id").agg(F.count("*").alias("entity_count"))
    r = relations.groupBy("source_id").agg(F.count("*").alias("relation_count"))
    out = sources.select("source_id").distinct().join(e, "source_id", "left").join(r, "source_id", "left")
    return out.select("source_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("entity_count", "relation_count")])


def error_histogram(errors: DataFrame) -> DataFrame:
    """(code, n)."""
    return errors.groupBy("code").agg(F.count("*").alias("n"))


def file_results(chunks: DataFrame) -> DataFrame:
    """(file, chunks): the chunks of each file in order. ``chunks``: (file, chunk_index, source_id, status)."""
    c = F.sort_array(F.collect_list(F.struct("chunk_index", "source_id", "status")))
    return chunks.groupBy("file").agg(c.alias("chunks"))


def same_tool_groups(steps: DataFrame) -> DataFrame:
    """(run, grp, tool, ok, results): neighbouring observations of one tool, in order; ``ok`` if all are.

    ``steps``: (run, ord, tool, ok, result).
    """
    w = Window.partitionBy("run").orderBy("ord")
    start = F.coalesce(F.lag("tool").over(w) != F.col("tool"), F.lit(True))
    g = steps.withColumn("grp", F.sum(start.cast("int")).over(w))
    return g.groupBy("run", "grp", "tool").agg(F.min("ok").alias("ok"), F.transform(F.sort_array(F.collect_list(F.struct("ord", "result"))), lambda x: x["result"]).alias("results"))


def compact_warning(fields: list[str]):
    """A warning as JSON without its null fields."""
    return F.to_json(F.struct(*fields))
