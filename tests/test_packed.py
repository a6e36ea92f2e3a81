import random

from lexigraft.operators.packed import packed_fields, unpack_values

SCHEMA = "field string, record_id string, ids boolean, packed string"


def values(spark, *packed, ids=False):
    df = spark.createDataFrame([("f", str(i), ids, p) for i, p in enumerate(packed)], SCHEMA)
    out: dict = {i: [] for i in range(len(packed))}
    for r in sorted(unpack_values(df).collect(), key=lambda r: (int(r.record_id), r.pos)):
        assert r.pos == len(out[int(r.record_id)])
        out[int(r.record_id)].append(r.val)
    return [out[i] for i in range(len(packed))]


def test_separators_quotes_escapes(spark):
    got = values(
        spark,
        "a|b", "a||b| |c|", 'x; "y; z"；w', "Ataxia, late|Fever", "Ataxia, late", '"Ataxia, late", Fever', "a\r\nb\tc", "a / b/c / d", "a\\|b|c",
        '"q ""r"" s"|t', '["a, b", "c \\"d\\"", null, " "]', "[not json|x]", '5" wide|6', "a\\\\|b", " x ", "p、q", '" / "|k',
    )
    assert got == [
        ["a", "b"], ["a", "b", "c"], ["x", "y; z", "w"], ["Ataxia, late", "Fever"], ["Ataxia", "late"], ["Ataxia, late", "Fever"], ["a", "b", "c"], ["a", "b/c", "d"], ["a|b", "c"],
        ['q "r" s', "t"], ["a, b", 'c "d"'], ["[not json", "x]"], ['5" wide', "6"], ["a\\", "b"], ["x"], ["p", "q"], ["/", "k"],
    ]


def test_identifiers_never_hold_white_space(spark):
    assert values(spark, "A:1, B:2;C:3 D:4", '"A:1"|B:2', "A:1 B:2", '["A:1"]', ids=True) == [["A:1", "B:2", "C:3", "D:4"], ["A:1", "B:2"], ["A:1", "B:2"], ["A:1"]]


def test_nothing_in_nothing_out(spark):
    assert values(spark, None, "", "  ", "|;|", " ", "[]", '""') == [[]] * 7
    assert unpack_values(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_fields_and_ties(spark):
    many = "|".join(f'"v, {i}"' for i in range(50_000))
    got = values(spark, many, "same|same|same")
    assert len(got[0]) == 50_000 and got[0][-1] == "v, 49999" and got[1] == ["same"] * 3


def test_brute_force_on_random_fields(spark):
    r = random.Random(5)
    cases, want = [], []
    for _ in range(200):
        sep = r.choice(["|", ";", "；", "、", "\n", "\t", " / ", ", "])
        vals = ["".join(r.choice("abc-é'") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 6))]
        quoted = [v if r.random() < 0.6 else f'"{v}{sep}{v}"' for v in vals]
        cases.append(sep.join(quoted))
        want.append([q if not q.startswith('"') else q[1:-1] for q in quoted])
    assert values(spark, *cases) == want


def test_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([("1", "a|b", "z"), ("1", "a|b", "z"), (None, "c", "z")], "field string, packed string, ids string")
    u = unpack_values(packed_fields(df, "t", "field", {"packed": False})).distinct()
    assert sorted((r.record_id or "", r.pos, r.val) for r in u.collect()) == [("", 0, "c"), ("1", 0, "a"), ("1", 1, "b")]
