"""The stored graph: commits, exports, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigraft.session import checkpointed


def uncommitted(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """Chunks whose id is not stored yet. Put before any costly stage: joins do not move below it."""
    return chunks.join(sources.select("source_id"), "source_id", "left_anti")


def already_committed(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    return chunks.join(sources.select("source_id"), "source_id", "left_semi")


def number_rows(rows: DataFrame, order: list[str], start: int, out: str = "id") -> DataFrame:
    """Consecutive ids from ``start`` in the given total order, without one task holding all rows.

    Rows are range-partitioned on the order; each partition counts itself, the counts (one per
    partition) become offsets, and ids follow from a window inside the partition.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    ranged = ranged.withColumn("__i", F.monotonically_increasing_id() - F.shiftleft(F.col("__p").cast("long"), 33))
    ranged = checkpointed(ranged)  # partitions must be the same in both uses
    counts = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    offsets = counts.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__o"))
    return ranged.join(F.broadcast(offsets), "__p").withColumn(out, (F.col("__o") + F.col("__i") + start).cast("long")).drop("__p", "__i", "__o")


def resolve_ends(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Draft ends to stored ids through (source_id, name, type).

    ``relations``: (source_id, ord, subject_name, subject_type, relation_type, object_name, object_type).
    """
    e = entities.groupBy("source_id", "name", "entity_type").agg(F.min("id").alias("id"))
    s = e.select("source_id", F.col("name").alias("subject_name"), F.col("entity_type").alias("subject_type"), F.col("id").alias("subject_entity_id"))
    o = e.select("source_id", F.col("name").alias("object_name"), F.col("entity_type").alias("object_type"), F.col("id").alias("object_entity_id"))
    return relations.join(s, ["source_id", "subject_name", "subject_type"]).join(o, ["source_id", "object_name", "object_type"])


def named_relations(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Relations with the names of both ends."""
    s = entities.select(F.col("id").alias("subject_entity_id"), F.col("name").alias("subject_entity_name"))
    o = entities.select(F.col("id").alias("object_entity_id"), F.col("name").alias("object_entity_name"))
    return (
        relations.join(s, "subject_entity_id")
        .join(o, "object_entity_id")
        .select("id", "subject_entity_id", "subject_entity_name", "relation_type", "object_entity_id", "object_entity_name", "source_id")
    )


def source_results(sources: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(source_id, entities, relations): what is stored for each source, both lists in id order."""
    e = entities.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct("id", "name", "entity_type"))).alias("entities"))
    r = relations.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct("id", "subject_entity_id", "relation_type", "object_entity_id"))).alias("relations"))
    none = lambda c: F.coalesce(F.col(c), F.array())
    return sources.select("source_id").distinct().join(e, "source_id", "left").join(r, "source_id", "left").select("source_id", none("entities").alias("entities"), none("relations").alias("relations"))


def commit_batch(drafts: DataFrame, store: str, batch: int) -> None:
    """Append one batch of drafts to the three tables of a store, exactly once.

    ``drafts``: (source_id, source_name, text, entities array<struct<name,entity_type>>, relations
    array<struct<subject int, relation_type, object int>>) with 0-based ends. Every table is written
    under ``batch=<n>`` in overwrite mode, so a repeated batch replaces itself; sources already
    stored by other batches are left out, and so are sources whose drafts break uniqueness. The
    sources table is written last: a batch counts as stored once it is there.
    """
    spark = drafts.sparkSession
    old = _read(spark, f"{store}/sources", "source_id string, source_name string, text string, batch int").where(F.col("batch") != batch)
    d = uncommitted(drafts.dropDuplicates(["source_id"]), old)
    sound = (F.size(F.array_distinct("entities")) == F.size("entities")) & (F.size(F.array_distinct("relations")) == F.size("relations"))
    d = d.where(sound)
    top = lambda t: _read(spark, f"{store}/{t}", "id long, batch int").where(F.col("batch") < batch).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    e = d.select("source_id", F.posexplode("entities").alias("ord", "e")).select("source_id", "ord", "e.name", "e.entity_type")
    _write(number_rows(e, ["source_id", "ord"], top("entities") + 1), f"{store}/entities", batch)
    e = spark.read.parquet(f"{store}/entities/batch={batch}").select("source_id", "ord", "id")
    r = d.select("source_id", F.posexplode("relations").alias("ord", "r")).select("source_id", F.col("ord").alias("rord"), "r.*")
    r = r.join(e.select("source_id", F.col("ord").alias("subject"), F.col("id").alias("subject_entity_id")), ["source_id", "subject"])
    r = r.join(e.select("source_id", F.col("ord").alias("object"), F.col("id").alias("object_entity_id")), ["source_id", "object"])
    r = r.select("source_id", "rord", "subject_entity_id", "relation_type", "object_entity_id")
    _write(number_rows(r, ["source_id", "rord"], top("relations") + 1), f"{store}/relations", batch)
    _write(d.select("source_id", "source_name", "text"), f"{store}/sources", batch)


def _write(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _read(spark, path: str, schema: str) -> DataFrame:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def export_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """CSV with header and byte order mark; ``single`` asks for one file in row order."""
    first = df.columns[0]
    out = df.withColumnRenamed(first, "\ufeff" + first)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
