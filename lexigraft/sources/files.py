"""Text directories, written pages and result files."""

from __future__ import annotations

import hashlib
import json
import os

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def utf8_text(content: pd.Series) -> pd.Series:
    """UTF-8 with invalid bytes dropped; a byte order mark stays."""
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def read_text_dir(spark: SparkSession, root: str) -> DataFrame:
    """(relative_path, source_name, text) of every .txt and .md file below a folder, any case, sorted by path."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    f = f.where(F.lower("path").rlike(r"\.(txt|md)$"))
    base = os.path.abspath(root).rstrip("/") + "/"
    rel = F.regexp_replace(F.url_decode(F.regexp_replace("path", "%(?![0-9A-Fa-f]{2})|\\+", "%2B")), "^(?:file:/*)?/?" + base.lstrip("/").replace(".", r"\."), "")
    return f.select(rel.alias("relative_path"), F.element_at(F.split(rel, "/"), -1).alias("source_name"), utf8_text("content").alias("text")).orderBy(F.split("relative_path", "/"))


def output_name(stem: str, path: str, suffix: str, limit: int = 255) -> str:
    """A file name of at most ``limit`` bytes; longer stems are cut between characters and get a hash of the path."""
    part = f"{suffix}.part"
    if len((stem + part).encode()) <= limit:
        return stem + suffix
    tag = "--" + hashlib.sha256(path.encode()).hexdigest()[:16]
    room = limit - len((tag + part).encode())
    return stem.encode()[:room].decode("utf-8", "ignore") + tag + suffix


def output_path(relative: Column, suffix: str = ".json") -> Column:
    """The mirrored path: the last suffix replaced. Files that differ in suffix only meet there, last one wins."""
    return F.concat(F.regexp_replace(relative, r"(?<=[^/])\.[^./]*$", ""), F.lit(suffix))


def not_yet_written(inputs: DataFrame, outputs: DataFrame, key: str = "output") -> DataFrame:
    """Inputs whose output is not there."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def write_file_per_row(rows: DataFrame, root: str, path: str = "output", content: str = "content") -> None:
    """One file per row in a shared folder, each under a temporary name first."""

    def put(part) -> None:
        for r in part:
            to = os.path.join(root, r[path])
            os.makedirs(os.path.dirname(to), exist_ok=True)
            with open(to + ".part", "w", encoding="utf-8") as f:
                f.write(r[content])
            os.replace(to + ".part", to)

    rows.select(path, content).foreachPartition(put)


@F.pandas_udf(T.StringType())
def pretty_json(raw: pd.Series) -> pd.Series:
    """JSON with an indent of two and characters as they are."""
    return raw.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2))


def result_files(chunks: DataFrame) -> DataFrame:
    """(output, content): one JSON document per file. ``chunks``: (relative_path, source_name, chunk_index, result struct)."""
    g = chunks.groupBy("relative_path", "source_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", F.to_json("result").alias("j")))), lambda x: x["j"]).alias("js"))
    head = F.regexp_replace(F.to_json(F.struct("source_name", "relative_path")), r"\}$", "")
    return g.select(output_path(F.col("relative_path")).alias("output"), pretty_json(F.concat(head, F.lit(',"chunks":['), F.array_join("js", ","), F.lit("]}"))).alias("content"))


def find_pdfs(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, length) of PDF files, once each; empty files are left out, as the reader skips them."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.pdf").load(root)
    return f.select("path", "length").where("length > 0").dropDuplicates(["path"])
