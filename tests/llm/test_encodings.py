from lexigraft.llm.encodings import CHAINS, LOST, forms_of, garble, garbled_hits, repaired, tokens_of, units_of

FR = "Pendant la période d’essai, une fièvre modérée – « déjà vu » – a cédé à l’été."
ZH = "据登记簿，四十例金溪墨合剂中手足发凉时轻时重，脉象偏细。"


def wrong(t, *chain):
    return garble(t, chain)


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, form int")


def test_found_and_restored(spark):
    bad = [wrong(FR, ("utf-8", d)) for d in ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251")] + [wrong(FR, ("utf-8", "cp1252"), ("utf-8", "cp1252")), FR + "\n" + wrong("fièvre", ("utf-8", "cp1252"))]
    bad += [wrong(ZH, ("utf-8", d)) for d in ("cp1252", "latin-1", "mac_roman", "gb18030")] + [wrong(ZH, ("gb18030", "latin-1")), wrong(FR, ("cp1252", "utf-8")), wrong(ZH, ("gb18030", "utf-8"))]
    clean = [FR, ZH, "plain", "SÃO JOÃO", "├── a\n│   └── b", "α-β 25 °C ± 3 µg ½", "ΑΒΓ", "Füße", None, "", " "]
    d = docs(spark, clean + bad)
    found = {r.doc_id for r in garbled_hits(d).select("doc_id").distinct().collect()}
    assert found == set(range(len(clean), len(clean) + len(bad)))
    back = {r.doc_id: (r.text, r.restored) for r in repaired(d).collect()}
    for n, want in enumerate([FR] * 7 + [FR + "\nfièvre"]):
        assert back[len(clean) + n] == (want, True), n
    assert not back[len(clean) + len(bad) - 1][1]


def test_han_restored(spark):
    for read in ("cp1252", "latin-1", "mac_roman"):
        back = repaired(docs(spark, [ZH, ZH, wrong(ZH, ("utf-8", read))])).collect()
        assert [(r.doc_id, r.text, r.restored) for r in back] == [(2, ZH, True)], read


def test_pieces():
    assert tokens_of("plain ascii") == set() and units_of("") == set() and f"d{LOST}c" in tokens_of(f"d{LOST}crit")
    assert all(f != u for u in ("é", "据登", "déjà") for f, _ in forms_of(u)) and len(CHAINS) > 30
    assert {"据", "登", "据登"} <= units_of("据登") and len(tokens_of("é" * 20_000)) < 20


def test_empty_and_repeated(spark):
    assert garbled_hits(docs(spark, ["x"]).limit(0)).count() == 0
    d = docs(spark, [FR, wrong(FR, ("utf-8", "cp1252"))] + [wrong(FR, ("utf-8", "cp1252"))] * 3)
    assert {r.doc_id for r in garbled_hits(d).select("doc_id").distinct().collect()} == {1, 2, 3, 4}


def test_long_words_and_lone_signs(spark):
    word = "anticonstitutionnellementdéshydrogénationsupercalifragilisticexpial"
    d = docs(spark, [f"le {word} court", wrong(f"un {word} long", ("utf-8", "cp1252")), f"broken {LOST} sign", LOST, f"x {LOST}", "où"])
    hits = garbled_hits(d).collect()
    assert {r.doc_id for r in hits} == {1} and any(r.original == word for r in hits)
    assert garbled_hits(docs(spark, [LOST])).count() == 0 and garbled_hits(docs(spark, [f"{LOST}{LOST}", None])).count() == 0


def test_lost_letter_in_place(spark):
    d = docs(spark, ["für alle", f"f{LOST}r mich", f"f{LOST}{LOST}r uns", f"x{LOST}y"])
    assert {r.doc_id for r in garbled_hits(d).collect()} == {1, 2}


def test_restored_characters(spark):
    """Accuracy of repair on planted texts: every sign of texts under one chain comes back."""
    texts = [FR, FR.replace("fièvre", "gêne"), ZH] * 3
    bad = [wrong(t, ("utf-8", c)) for t in (FR, FR.replace("fièvre", "gêne")) for c in ("cp1252", "mac_roman", "cp437")]
    back = {r.doc_id: r.text for r in repaired(docs(spark, texts + bad)).collect()}
    want = [t for t in (FR, FR.replace("fièvre", "gêne")) for _ in range(3)]
    same = sum(sum(a == b for a, b in zip(back[len(texts) + i], t)) for i, t in enumerate(want))
    assert same / sum(map(len, want)) > 0.99
