import unicodedata
from types import SimpleNamespace

import pytest

from lexigraft.llm import confusables
from lexigraft.llm.confusables import LOOKALIKES, Skeletons, canonical, lookalike_classes, lookalike_pairs, lookalike_table, skeleton

SCHEMA = "id long, name string, source_id string, skeleton string"


def test_same_look():
    for a, b in (
        ("Ｆｅｖｅｒ", "Fever"), ("café", "café"), ("fe​ver﻿", "fever"), ("a b", "a b"), ("a　b", "a b"), ("x‑y", "x-y"), ("ﬁne", "fine"), ("Роkоritel", "Pokoritel"),
        ("⼭岚", "山岚"), ("金", "金"), ("²", "2"), ("Α-x", "A-x"), ("fe­ver", "fever"), ("カ", "力"), ("ｶ", "力"),
    ):
        assert skeleton(a) == skeleton(b) and canonical(a) == canonical(b), (a, b)


def test_other_look():
    for a, b in (("Fever", "fever"), ("café", "cafe"), ("ab", "a b"), ("l", "I"), ("0", "O"), ("证", "證"), ("a.b", "ab"), ("a", "b")):
        assert skeleton(a) != skeleton(b), (a, b)


def test_defined_results():
    assert skeleton(None) is None and skeleton("") == "" and skeleton("​⁠") == "" and canonical("é") == "é"
    assert len(skeleton("é" * 200_000)) == 400_000 and len(LOOKALIKES) < 200
    assert all(skeleton(skeleton(c)) == skeleton(c) for c in map(chr, range(32, 0x3000)) if unicodedata.category(c) not in ("Cs", "Cn"))


def test_pairs_against_brute_force(spark):
    names = ["Fever", "Fe​ver", "Ｆｅｖｅｒ", "fever", None, "", "café", "café", "Fever"]
    rows = [(i, n, s, "q") for i, n in enumerate(names) for s in ("s",)] + [(20, "Fever", "t", "q"), (21, "Fеver", "t", "q"), (22, "Fever", None, "q"), (23, "F⁠ever", None, "q"), (1, "Fe​ver", "s", "r")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[2] and a[2] == b[2] and a[1] and b[1] and a[1] != b[1] and skeleton(a[1]) == skeleton(b[1])}
    assert {tuple(r) for r in lookalike_pairs(df, "id", "name", "source_id").collect()} == want and len(want) == 7
    assert lookalike_pairs(df.limit(0), "id", "name", "source_id").count() == 0


def test_hot_name_of_equal_characters(spark):
    df = spark.range(30_000).selectExpr("id", "'same' name", "'s' source_id")
    assert lookalike_pairs(df, "id", "name", "source_id").count() == 0


def test_letters_of_the_library(spark):
    table = lookalike_table(spark)
    of = Skeletons(table).of
    for a, b in (("hҽllo", "hello"), ("ⲤOP", "COP"), ("ꓐOX", "BOX"), ("𝐟𝐞𝐯𝐞𝐫", "fever"), ("Іron", "Iron")):
        assert of(a) == of(b), (a, b, of(a))
    for a, b in (("l", "I"), ("1", "l"), ("0", "O"), ("m", "rn"), ("é", "e"), ("未", "末"), ("土", "士")):
        assert of(a) != of(b), (a, b)
    assert 200 < len(table) < 20_000


def test_missing_library_is_an_error(spark, monkeypatch):
    jvm = spark.sparkContext._jvm
    for text in (jvm.no.such.text, _icu_text("a\nb")):
        monkeypatch.setattr(confusables, "_TABLE", {})
        bare = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=SimpleNamespace(com=SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=text))))))
        with pytest.raises(RuntimeError, match="ICU library"):
            lookalike_table(bare)
        assert not confusables._TABLE


def _icu_text(looks):
    checker = SimpleNamespace(getSkeleton=lambda _: looks)
    return SimpleNamespace(SpoofChecker=SimpleNamespace(Builder=lambda: SimpleNamespace(build=lambda: checker)))


def test_classes(spark):
    df = spark.createDataFrame([(1, "Fever", "s"), (2, "Fеver", "s"), (3, "Fever", "s"), (4, "cough", "s"), (5, "Fеver", "t"), (6, None, "s")], "id long, name string, source_id string")
    got = {r.id: (r["class"], r.links) for r in lookalike_classes(df, "id", "name", "source_id").collect()}
    assert {k: v[1] for k, v in got.items()} == {1: 1, 2: 2, 3: 1} and len({v[0] for v in got.values()}) == 1
