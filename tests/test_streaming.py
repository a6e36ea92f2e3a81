import json

from lexigraft.plans.graph import ONTOLOGY
from lexigraft.streaming.ingest import commit_stream, replay_stream, stream_table


def test_stateful_replay(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "source_id string, text string, ord int, tool string, arguments string"
    add = json.dumps({"name": "fever", "entity_type": "disease"})
    spark.createDataFrame([("a", "a fever", 1, "add_entity", add)], schema).write.parquet(str(tmp_path / "in"))
    calls = stream_table(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)

    def run():
        q = replay_stream(calls, ONTOLOGY).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    spark.createDataFrame([("a", "a fever", 2, "add_entity", add), ("a", "a fever", 3, "validate_chunk", "{}"), ("a", "a fever", 4, "submit_chunk", "{}")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    rows = sorted((r.ord, r.ok) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [(1, True), (2, True), (3, True), (4, True)]


def test_commit_stream(spark, tmp_path):
    schema = "source_id string, source_name string, text string, entities array<struct<name:string,entity_type:string>>, relations array<struct<subject:int,relation_type:string,object:int>>"
    rows = [("a", "f", "x", [{"name": "p", "entity_type": "t"}], [])]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    s = stream_table(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    q = commit_stream(s, str(tmp_path / "store"), str(tmp_path / "log"))
    q.processAllAvailable()
    spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "store" / "entities")).count() == 1
