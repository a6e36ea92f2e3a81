import random

from pyspark.sql import functions as F

from lexigraft.operators import graph, reports
from lexigraft.operators import tables as t
from lexigraft.sources import dumps, files


def test_hierarchy_examples(spark):
    titles = ["A", "- B", "- - - C", "- D", "E", "- - F"]
    df = spark.createDataFrame(list(enumerate(titles)), "n int, title string")
    p = [r.parent for r in t.hierarchy(df, "n", t.dash_level(F.col("title"))).orderBy("n").collect()]
    assert p == [None, "A", "- B", "A", None, "E"]
    assert [spark.range(1).select(f(F.lit("Non-X")).alias("v")).first().v for f in (t.dash_level, t.leading_dash_level)] == [1, 0]


def test_hierarchy_against_stack(spark):
    r = random.Random(2)
    rows, want = [], {}
    for g in range(20):
        stack = []
        for i in range(30):
            level, name = r.randint(0, 5), f"{g}.{i}"
            del stack[level:]
            want[name] = stack[-1] if stack else None
            stack.append(name)
            rows.append((g, i, level, name))
    df = spark.createDataFrame(rows, "g int, i int, l int, title string")
    assert {x.title: x.parent for x in t.hierarchy(df, "i", F.col("l"), by=["g"]).collect()} == want


def test_obo(spark, tmp_path):
    (tmp_path / "hp.obo").write_text("format-version: 1\n\n[Term]\nid: HP:1\nsynonym: a\nsynonym: b: c\n\n[Term]\nid: HP:2\n\n[Typedef]\nid: x\n")
    rows = sorted((r.id, r.synonym) for r in dumps.read_obo(spark, str(tmp_path / "hp.obo")).collect())
    assert rows == [("HP:1", "a||b: c"), ("HP:2", None)]
    old = dumps.read_obo(spark, str(tmp_path / "hp.obo"), compat=True)
    assert sorted(r.id or "" for r in old.collect()) == ["", "HP:1"]


def test_obo_files_stay_apart(spark, tmp_path):
    for n in "AB":
        (tmp_path / f"{n}.obo").write_text(f"format-version: 1\n\n[Term]\nid: {n}:1\nname: n{n}\n\n[Term]\nid: {n}:2\n")
    got = sorted((r.id, r.name) for r in dumps.read_obo(spark, str(tmp_path)).collect())
    assert got == [("A:1", "nA"), ("A:2", None), ("B:1", "nB"), ("B:2", None)]
    assert sorted(r.id for r in dumps.read_obo(spark, str(tmp_path), compat=True).where("id is not null").collect()) == ["A:1", "B:1"]


def test_deep_hierarchy(spark):
    rows = spark.createDataFrame([(i, "-" * i + f"t{i}") for i in range(100)], "n int, title string")
    got = t.hierarchy(rows, "n", t.leading_dash_level(F.col("title"))).orderBy("n").collect()
    assert [r.depth for r in got] == list(range(100)) and [r.parent for r in got] == [None, *("-" * i + f"t{i}" for i in range(99))]


def test_titles_are_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('title\n"a, b"\n\n"say ""x"""\nplain\n')
    assert [r.title for r in dumps.read_titles(spark, str(tmp_path / "t.csv")).orderBy("ord").collect()] == ["a, b", 'say "x"', "plain"]


def test_mesh_and_tables(spark, tmp_path):
    (tmp_path / "c.bin").write_text("*NEWRECORD\nNM = x = y\nSY = a|T1\nSY = b|T2\nUI = C1\n*NEWRECORD\nNM = z\nUI = C2\n")
    m = {r.UI: (r.NM, r.SY) for r in dumps.read_mesh(spark, str(tmp_path / "c.bin")).collect()}
    assert m == {"C1": ("x = y", "a|T1||b|T2"), "C2": ("z", None)}
    (tmp_path / "d.tsv").write_text("McId\tDiseaseName\tDiseaseSlug\tAliases\tExternalIds\nM1\tn\ts\t a | |b\tUMLS:C1|OMIM:2\n")
    d = dumps.read_malacards(spark, str(tmp_path / "d.tsv"))
    assert d.select(t.clean_aliases(F.col("Aliases")).alias("a")).first().a == "a|b" and t.grouped_ids(d, "McId", "ExternalIds").first().ids == {"UMLS": ["C1"], "OMIM": ["2"]}
    (tmp_path / "g.tsv").write_text("MCId\tGeneSymbol\tOther\nM1\tG\tq\n")
    g = t.keep_columns(dumps.read_table(spark, str(tmp_path / "g.tsv"), sep="\t"), dumps.GENES, {"MCId": "McId"})
    assert g.columns == ["McId", "GeneSymbol"]


def test_xml_and_json(spark, tmp_path):
    (tmp_path / "d.xml").write_text('<drugbank xmlns="http://x"><drug><drugbank-id>DB1</drugbank-id><drugbank-id>X</drugbank-id><name>n</name><synonyms><synonym>b</synonym><synonym>a</synonym></synonyms><targets><drug><name>inner</name></drug></targets></drug></drugbank>')
    assert [tuple(r) for r in dumps.read_drugs(spark, str(tmp_path / "d.xml")).collect()] == [("DB1", "n", None, "a||b")]
    (tmp_path / "g.xml").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?><JDBOR><DisorderList><Disorder><OrphaCode>5</OrphaCode><DisorderGeneAssociationList><DisorderGeneAssociation><Gene><Symbol>é1</Symbol></Gene></DisorderGeneAssociation><DisorderGeneAssociation><Gene><Symbol>G2</Symbol></Gene></DisorderGeneAssociation></DisorderGeneAssociationList></Disorder></DisorderList></JDBOR>'.encode("latin-1"))
    assert sorted(tuple(r) for r in dumps.read_disorder_genes(spark, str(tmp_path / "g.xml")).collect()) == [("5", "G2"), ("5", "é1")]
    (tmp_path / "o.json").write_text('{"JDBOR":[{"DisorderList":[{"Disorder":[{"id":"1","OrphaCode":"9"}]}]}]}')
    assert [tuple(r) for r in dumps.read_disorders(spark, str(tmp_path / "o.json")).select("id", "OrphaCode").collect()] == [("1", "9")]


def test_ids_and_trees(spark):
    df = spark.createDataFrame([("UMLS:C3149220|OMIM:1234|UMLS:0012345|ICD10:C12",), (None,)], "x string")
    assert [r.c for r in df.select(t.umls_ids(F.col("x")).alias("c")).collect()] == [["C0012345", "C3149220"], []]
    trees = t.tree_numbers(spark.createDataFrame([("C23.888",), ("C23.888.069||A1",), ("C23.888.069.100",), ("C23.888.119",), (None,)], "MN string"), "MN", "C23.888")
    s = t.tree_stats(trees).first()
    assert (s.roots, s.classes, s.leaves, s.max_depth, round(s.avg_leaf_depth, 4), s.avg_width, s.fan_out) == (2, 4, 3, 2, 1.6667, 2.0, 1.0)
    names = t.names_of(spark.createDataFrame([("D1", "a|T1||b|T2", "M"), ("D2", None, "N")], "UI string, ENTRY string, MH string"), "UI", "ENTRY", "MH")
    assert sorted(tuple(r) for r in names.collect()) == [("D1", "M"), ("D1", "a"), ("D1", "b"), ("D2", "N")]
    ids = [spark.createDataFrame([(x,)], "k int") for x in (1, 2, 3)]
    assert sorted(r.c for r in t.in_any(spark.createDataFrame([(1,), (1,), (4,), (3,)], "c int"), "c", ids).collect()) == [1, 1, 3]


def test_commit_is_idempotent(spark, tmp_path):
    schema = "source_id string, source_name string, text string, entities array<struct<name:string,entity_type:string>>, relations array<struct<subject:int,relation_type:string,object:int>>"
    ent = lambda *n: [{"name": x, "entity_type": "t"} for x in n]
    one = spark.createDataFrame([("a", "f", "x", ent("p", "q"), [{"subject": 0, "relation_type": "r", "object": 1}]), ("b", "f", "y", ent("p", "p"), []), ("c", "f", "z", [], [])], schema)
    store = str(tmp_path / "store")
    graph.commit_batch(one, store, 0)
    graph.commit_batch(one, store, 0)
    graph.commit_batch(one.unionByName(spark.createDataFrame([("d", "g", "w", ent("k"), [])], schema)), store, 1)
    e = sorted((r.id, r.source_id, r.name) for r in spark.read.parquet(f"{store}/entities").collect())
    assert e == [(1, "a", "p"), (2, "a", "q"), (3, "d", "k")]  # b breaks uniqueness and is left out
    assert sorted(r.source_id for r in spark.read.parquet(f"{store}/sources").collect()) == ["a", "c", "d"]
    r = spark.read.parquet(f"{store}/relations").first()
    assert (r.id, r.subject_entity_id, r.object_entity_id) == (1, 1, 2)


def test_summary_and_export(spark, tmp_path):
    c = spark.createDataFrame([("f", s) for s in ("committed", "already_committed", "failed", "max_steps_exceeded")], "file string, status string")
    assert tuple(reports.run_summary(c).first()) == (1, 4, 1, 1, 1, 2)
    graph.export_csv(spark.createDataFrame([(1, "é")], "id int, name string"), str(tmp_path / "x"))
    raw = next((tmp_path / "x").glob("*.csv")).read_bytes()
    assert raw == b"\xef\xbb\xbfid,name\n1,\xc3\xa9\n"


def test_text_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "b.TXT").write_bytes(b"ok\xff!")
    (tmp_path / "in" / "sub" / "a b.md").write_text("﻿中")
    (tmp_path / "in" / "c.pdf").write_bytes(b"")
    rows = [(r.relative_path, r.source_name, r.text) for r in files.read_text_dir(spark, str(tmp_path / "in")).collect()]
    assert rows == [("b.TXT", "b.TXT", "ok!"), ("sub/a b.md", "a b.md", "﻿中")]
    (tmp_path / "in" / "sub" / "d.pdf").write_bytes(b"%PDF")
    assert [r.path[-9:] for r in files.find_pdfs(spark, str(tmp_path / "in")).collect()] == ["sub/d.pdf"]
    long = files.output_name("名" * 200, "/p", ".txt")
    assert len(long.encode()) <= 255 and long.endswith(".txt") and "--" in long and files.output_name("a", "/p", ".md") == "a.md"
    out = spark.createDataFrame([("d/a.txt", "a.txt", 1, ("x",)), ("d/a.txt", "a.txt", 0, ("中",))], "relative_path string, source_name string, chunk_index int, result struct<s:string>")
    files.write_file_per_row(files.result_files(out), str(tmp_path / "o"))
    import json

    doc = json.loads((tmp_path / "o" / "d" / "a.json").read_text())
    assert doc == {"source_name": "a.txt", "relative_path": "d/a.txt", "chunks": [{"s": "中"}, {"s": "x"}]}
