import random

import pytest

from lexigraft.llm.chunking import split_oversized


def pieces(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, t string, piece string")
    out: dict = {}
    for r in sorted(split_oversized(df, "k", "t", **kw).collect(), key=lambda r: (r.k or "", r.chunk_index)):
        out.setdefault(r.k, []).append(r)
    return out


def check(text, ps, limit, overlap):
    assert "".join(p.core for p in ps) == text and [p.chunk_index for p in ps] == list(range(len(ps)))
    at = 0
    for p in ps:
        assert len(p.piece) <= limit and p.piece == text[at - p.overlap_chars : at + len(p.core)]
        assert p.overlap_chars == 0 if at == 0 else overlap - 5 <= p.overlap_chars <= overlap + 20
        at += len(p.core)


def test_boundaries_in_order_of_strength(spark):
    para, line, sent = "p" * 500 + "\n\n", "l" * 300 + "\n", "Words and more. "
    text = para + line + sent * 100
    ps = pieces(spark, [("a", text, "x")])["a"]
    check(text, ps, 1000, 100)
    assert ps[0].core.endswith("\n\n") and all(p.core.endswith(". ") or p is ps[-1] for p in ps[2:])


def test_characters_where_there_is_no_boundary(spark):
    for text in ("x" * 5000, "中" * 2500, "😀" * 1500):
        check(text, pieces(spark, [("a", text, None)])["a"], 1000, 100)


def test_random_texts(spark):
    r = random.Random(4)
    texts = {str(i): "".join(r.choice(["word ", "中文，", "end. ", "\n", "\n\n", "é😀", "a", "。", " ", "\t"]) for _ in range(r.randint(900, 4000))) for i in range(40)}
    got = pieces(spark, [(k, t, None) for k, t in texts.items()])
    for k, t in texts.items():
        check(t, got[k], 1000, 100) if len(t) > 1000 else None
        assert (k in got) == (len(t) > 1000)


def test_edges(spark):
    rows = [("n", None, ""), ("e", "", ""), ("b", " " * 1000, ""), ("l", "y" * 1001, "q"), ("l", "y" * 1001, "z"), (None, "z" * 1200, "q")]
    got = pieces(spark, rows)
    assert set(got) == {"l", None} and len(got["l"]) == 2
    kept = pieces(spark, rows, keep_short=True)
    assert {k: len(v) for k, v in kept.items()} == {"e": 1, "b": 1, "l": 2, None: 2}
    assert pieces(spark, [("a", "q" * 300_000, "")])["a"][-1].chunk_index > 300
    assert split_oversized(spark.createDataFrame([], "k string, t string"), "k", "t").count() == 0
    with pytest.raises(ValueError):
        pieces(spark, rows, limit=100, overlap=100)
