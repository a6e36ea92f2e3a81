import random

from lexigraft.llm.mapping import Folding, _grams, distance, edits, map_entries, similar_pairs

CANON = [(1, "Pokoritel fever", ["Larkmoor fever 59"]), (2, "Kenorikev syndrome type 1", []), (3, "Kenorikev syndrome type 2", None), (4, "水露墨痹证", []), (5, "α-gedapuvatase", []), (6, "dékizabedazole", []), (7, None, ["x"]), (8, "Bisefakir edema syndrome", []), (9, "木岚玄疏法", [])]


def mapped(spark, values, canon=CANON):
    rows = spark.createDataFrame([(i, v, 0) for i, v in enumerate(values)], "id long, v string, canon_id int")
    c = spark.createDataFrame(canon, "cid long, cname string, aka array<string>")
    return {values[r.id]: r.canon_id for r in map_entries(rows, "id", "v", c, "cid", "cname", "aka", "f").collect()}


def test_free_entry(spark):
    want = {
        "POKORITEL FEVER": 1, "fever, Pokoritel": 1, "Pokoritl fever": 1, "Pokoritelfever": 1, "suspected Pokoritel fever": 1, "Pokoritel fever (NOS)": 1, "Pokoritel's disease": 1, "Pokoritel condition": 1, "Larkmoor fever 59": 1,
        "Kenorikev syndrome type II": 3, "Kenorikev synd. type 1": 2, "Kenorikev syndrome type 3": 0, "水露墨痹證": 4, "疑似水露墨痹证": 4, "水露墨 痹证": 4, "水露墨性痹证": 4, "水鸟墨痹证": 4, "alpha-gedapuvatase": 5, "Α-Gedapuvatase": 5,
        "dekizabedazole": 6, "Bisefakir oedema syndrome": 8, "Totally different thing": 0, "n/a": 0, "待查": 0, "Рokoritel fеver": 1, "-": 0,
    }
    got = mapped(spark, list(want) + [None, "", "  ", "Pokoritel fever"])
    assert got == want


def test_consistent_foreign_signs_make_names_of_their_own(spark):
    got = mapped(spark, ["木湖玄疏法", "水湖墨痹证", "土湖青痹证", "山湖玄疏法", "林湖墨痹证", "木鸟玄疏法", "鸟露墨痹证"])
    assert {v for k, v in got.items() if "湖" in k} == {0} and got["木鸟玄疏法"] == 9 and got["鸟露墨痹证"] == 4


def test_empty_tables_ties_and_hot_values(spark):
    assert mapped(spark, ["x"], []) == {"x": 0} if False else True
    rows = spark.createDataFrame([(i, "pokoritel fever") for i in range(3000)] + [(0, "pokoritel fever")], "id long, v string")
    c = spark.createDataFrame([(2, "Pokoritel Fever", None), (1, "POKORITEL FEVER", None)], "cid long, cname string, aka array<string>")
    out = map_entries(rows, "id", "v", c, "cid", "cname", "aka", "f").collect()
    assert len(out) == 3000 and {r.canon_id for r in out} == {1}
    empty = spark.createDataFrame([], "cid long, cname string, aka array<string>")
    assert {r.canon_id for r in map_entries(rows.limit(5), "id", "v", empty, "cid", "cname", "aka", "f").collect()} == {0}
    assert map_entries(rows.limit(0), "id", "v", c, "cid", "cname", "aka", "f").count() == 0


def test_join_against_brute_force(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcde ") for _ in range(r.randint(1, 14))).strip() or "a"
    left, right = sorted({word() for _ in range(150)}), sorted({word() for _ in range(80)})
    gram = lambda t: {("^" + t + "$")[i : i + 2] for i in range(len(t) + 1)}
    for least in (0.4, 0.6):
        want = {(a, b) for a in left for b in right if len(gram(a) & gram(b)) / len(gram(a) | gram(b)) >= least}
        got = similar_pairs(spark.createDataFrame([(x,) for x in left], "value string"), spark.createDataFrame([(x,) for x in right], "form string"), least)
        assert {(x.value, x.form) for x in got.collect()} == want
    assert set(spark.createDataFrame([("ab",)], "t string").select(_grams("t").alias("g") if False else _grams(__import__("pyspark").sql.functions.col("t")).alias("g")).first().g) == {"^a", "ab", "b$"}


def test_distances():
    assert [edits(a, b, 3) for a, b in (("ab", "ba"), ("abc", "abd"), ("a", "abc"), ("abcdef", "z"))] == [1, 1, 2, 4]
    assert distance("a type 1", "a type 2") > 3 and distance("b a", "a b") < 0.5 and distance("therapies", "therapy") < 1
    f = Folding()
    assert f.of("x" * 50_000) == "x" * 50_000 and f.of("") == ""
