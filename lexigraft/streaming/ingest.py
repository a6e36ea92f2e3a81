"""Streaming forms: idempotent ingestion of chunks and the draft machine over a stream of calls."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lexigraft.operators.drafts import Draft
from lexigraft.operators.graph import commit_batch
from lexigraft.sources.ontology import Ontology


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def commit_stream(drafts: DataFrame, store: str, checkpoint: str):
    """Commit drafts as they arrive. The batch number is the commit's key, so a batch that runs twice is stored once."""
    return drafts.writeStream.foreachBatch(lambda df, n: commit_batch(df, store, n)).option("checkpointLocation", checkpoint).start()


def first_seen(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Each key once; state older than the watermark is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


class DraftProcessor(StatefulProcessor):
    """Keeps one draft per chunk in the state store; calls must arrive in order within a chunk."""

    def __init__(self, ontology: Ontology):
        self.ontology = ontology

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("draft", "json string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = Draft.from_json(self.state.get()[0], self.ontology) if self.state.exists() else None
        out = []
        for pdf in rows:
            for text, n, tool, args in zip(pdf["text"], pdf["ord"], pdf["tool"], pdf["arguments"]):
                d = d or Draft(key[0], text or "", self.ontology)
                r = d.call(tool, json.loads(args or "{}"))
                out.append((key[0], n, tool, r["ok"], None if r["ok"] else r["error"]["code"]))
        self.state.update((d.to_json(),))
        yield pd.DataFrame(out, columns=["source_id", "ord", "tool", "ok", "code"])

    def close(self) -> None:
        pass


def replay_stream(calls: DataFrame, ontology: Ontology) -> DataFrame:
    """The stateful form of ``drafts.replay``."""
    return calls.groupBy("source_id").transformWithStateInPandas(
        statefulProcessor=DraftProcessor(ontology), outputStructType="source_id string, ord int, tool string, ok boolean, code string", outputMode="Append", timeMode="None"
    )
