from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigraft.operators.nested import dewey_nodes, flat_table, flat_tables, parent_label, prune_leaves, schema_paths

SCHEMA = "id string, node string, L array<struct<count:string,Item:array<struct<id:string,tag:string,Sub:array<struct<v:string>>>>>>, M array<array<struct<v:string>>>"
ROWS = [
    ("a", "x", [{"count": "9", "Item": [{"id": "1", "tag": None, "Sub": [{"v": "p"}, None]}, None, {"id": "2", "tag": "t", "Sub": []}]}, None, {"count": None, "Item": None}], None),
    ("a", "x", [{"count": "9", "Item": [{"id": "1", "tag": None, "Sub": [{"v": "p"}, None]}, None, {"id": "2", "tag": "t", "Sub": []}]}, None, {"count": None, "Item": None}], None),
    ("b", None, [], None),
    ("c", None, None, None),
    (None, None, [{"count": "0", "Item": [{"id": "7", "tag": None, "Sub": None}]}], None),
]


def labels(df):
    return sorted((r.id or "", r.schema_path, r.dewey) for r in df.distinct().collect())


def test_labels_keep_positions_and_skip_nulls(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert labels(dewey_nodes(df, "id", ["L"])) == [
        ("", "L", "0"), ("", "L.Item", "0.0"), ("a", "L", "0"), ("a", "L", "2"), ("a", "L.Item", "0.0"), ("a", "L.Item", "0.2"), ("a", "L.Item.Sub", "0.0.0"),
    ]


def test_pruned_scan_gives_the_same_labels(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.parquet(str(tmp_path / "t"))
    small = spark.read.schema(prune_leaves(df.schema, "id", ["L"])).parquet(str(tmp_path / "t"))
    assert "tag" not in small.schema.simpleString()
    assert labels(dewey_nodes(small, "id", ["L"])) == labels(dewey_nodes(df, "id", ["L"]))


def test_parents_by_truncation_and_clashing_names(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    t = flat_table(df, "id", "L.Item")
    assert t.columns == ["id", "node", "parent", "id_value", "tag"]
    assert {(r.node, r.parent, r.id_value, r.tag) for r in t.where("id = 'a'").collect()} == {("L.0.0", "L.0", "1", None), ("L.0.2", "L.0", "2", "t")}
    subs = flat_table(df, "id", "L.Item.Sub")
    assert subs.join(t, (subs["parent"] == t["node"]) & (subs["id"] == t["id"])).count() == 1
    assert set(flat_tables(df, "id", ["L"])) == {"L", "L.Item", "L.Item.Sub"}
    assert spark.range(1).select(parent_label(F.lit("3")).alias("p")).first().p is None


def test_empty_table_and_many_objects(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dewey_nodes(df, "id", ["L"]).count() == 0
    big = spark.createDataFrame([("z", None, [{"count": "1", "Item": [{"id": str(i), "tag": "y" * 50, "Sub": None} for i in range(5000)]}], None)], SCHEMA)
    assert dewey_nodes(big, "id", ["L"], keep={"L.Item"}).count() == 5000
    assert isinstance(schema_paths(df.schema, ["L"])["L.Item"], T.StructType)
