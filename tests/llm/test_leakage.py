import random

from lexigraft.llm.leakage import ItemIndex, find_leaks, normal_tokens

R = random.Random(9)
WORDS = [f"w{i}" for i in range(40)]
ITEM = " ".join(f"word{i}" for i in range(40))
ZH = "".join(chr(0x4E00 + 7 * i) for i in range(60))


def test_normal_form():
    assert normal_tokens("“Ａbc”,\\nd\\u00e9f\n中文") == ["abc", "déf", "中", "文"] and normal_tokens("") == []


def longest(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = row[j] + 1
                best = max(best, new[j + 1])
        row = new
    return best


def test_automaton_against_brute_force():
    items = [(i, "en", " ".join(R.choice(WORDS[:6]) for _ in range(R.randint(3, 30)))) for i in range(12)]
    idx = ItemIndex(items, 5, 5)
    for _ in range(300):
        doc = " ".join(R.choice(WORDS[:7]) for _ in range(R.randint(1, 40)))
        assert idx.leaks(doc) == {i for i, _, t in items if longest(doc.split(), t.split()) >= 5}


def test_limits_and_disguise(spark):
    w = ITEM.split()
    docs = [
        (1, "x " + " ".join(w[3:18]) + " y"), (2, " ".join(w[3:17])), (3, "A, " + ",\n".join(x.upper() for x in w[:20])), (4, ZH[5:40]), (5, ZH[5:39]), (6, None), (7, ""), (8, " "),
        (9, "\\n".join(w)), (10, " ".join(w[:14]) + " gap " + " ".join(w[14:28])), (11, "z " * 100_000 + ITEM), (1, "x " + " ".join(w[3:18]) + " y"),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, "en", ITEM), (2, "zh", ZH), (3, "en", ITEM), (4, "en", "short"), (5, None, None)], "item_id long, lang string, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, items).collect()}
    assert got == {(i, k) for i in (1, 3, 9, 11) for k in (1, 3)} | {(4, 2)}
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, items, max_item_tokens=100).collect()} == got  # items in several blocks
    assert find_leaks(d.limit(0), items).count() == 0 and find_leaks(d, items.limit(0)).count() == 0


def test_spans_and_cleaning(spark):
    from lexigraft.llm.leakage import cleaned, leaked_spans, normal_tokens, placed_tokens

    item = " ".join(f"word{i}" for i in range(30))
    short = "alpha beta gamma delta epsilon zeta"
    items = spark.createDataFrame([(1, "en", item), (2, "en", short)], "item_id long, lang string, text string")
    inside = "WORD3, word4\\nword5  word6 word7 “word8” " + " ".join(f"ｗord{i}" for i in range(9, 20))
    texts = [f"before {inside} after", "nothing here", None, "", "x alpha beta gamma delta epsilon y", "alpha beta gamma only", "été " + item]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.end, r.words, r.items) for r in leaked_spans(docs, items).collect()}
    assert got[0] == (7, 7 + len(inside), 17, [1]) and got[4][2:] == (5, [2]) and set(got) == {0, 4, 6} and got[6][2] == 30
    clean = {r.doc_id: (r.text, r.removed) for r in cleaned(docs, items).collect()}
    assert clean[0] == ("before  after", 1) and clean[4] == ("x  y", 1) and clean[6][0] == "été "
    for t in filter(None, texts):
        assert [x[0] for x in placed_tokens(t)] == normal_tokens(t)
    assert leaked_spans(docs, items.limit(0)).count() == 0 and cleaned(docs.limit(0), items).count() == 0
