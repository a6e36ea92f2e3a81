import random

import pytest
from pyspark.sql import functions as F

from lexigraft.operators import cleaning, layout
from lexigraft.operators.chunks import content_id, text_windows
from lexigraft.operators.review import local_context


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "t string").select(col.alias("c")).first().c


def test_windows(spark):
    t = "abcdefghijklmnopqrstuvwx"
    assert one(spark, t, text_windows(F.col("t"), 10, 3)) == [t[0:10], t[7:17], t[14:24]]
    assert one(spark, t[:10], text_windows(F.col("t"), 10, 3)) == [t[:10]] and one(spark, "", text_windows(F.col("t"))) == [""] and one(spark, None, text_windows(F.col("t"))) is None
    with pytest.raises(ValueError):
        text_windows(F.col("t"), 5, 5)
    r = random.Random(1)
    rows = [("".join(r.choice("ab中") for _ in range(r.randint(1, 60))),) for _ in range(100)]
    for x in spark.createDataFrame(rows, "t string").select("t", text_windows(F.col("t"), 9, 4).alias("c")).collect():
        want, at = [], 0
        while True:
            want.append(x.t[at : at + 9])
            if at + 9 >= len(x.t):
                break
            at += 5
        assert x.c == want


def test_content_id(spark):
    import hashlib

    for key, who in (("k", "k"), ("", "n"), (None, "n")):
        assert one(spark, "文", content_id(F.lit(key).cast("string"), F.lit("n"), F.col("t"))) == hashlib.sha256(f"{who}\0文".encode()).hexdigest()


def test_context_window(spark):
    t = "x" * 300 + "胸闷" + "y" * 300 + "胸闷"
    assert one(spark, t, local_context(F.col("t"), F.lit("胸闷"))) == "x" * 160 + "胸闷" + "y" * 160 + "\n…\n" + "y" * 160 + "胸闷"
    assert one(spark, "ab cd", local_context(F.col("t"), F.lit("cd|ab"))) == "ab cd" and one(spark, "ab", local_context(F.col("t"), F.lit("zz"))) == ""


def test_cleaning(spark):
    assert cleaning.cut_repeat("head " + "xy" * 50) == ("head ", True) and cleaning.cut_repeat("head " + "xy" * 49)[1] is False
    pages = spark.createDataFrame([(0, "head " + "xy" * 50), (1, None), (2, ""), (3, "z" * 300_000), (4, "a " + "." * 250 + " b"), (5, "\n 天地" * 100), (6, "foo  \nbar\n\n\n\nend ")], "id int, text string")
    got = {r.id: (r.text, r.abnormal) for r in cleaning.clean_pages(pages, "text").collect()}
    assert got[0] == ("head", True) and got[1] == (None, False) and got[2] == ("", False) and got[3][1] is True  # long and degenerate
    assert got[4] == ("a  b", True) and got[5][1] is True and got[6] == ("foo bar\n\nend", False) and cleaning.clean_pages(pages.limit(0), "text").count() == 0
    assert cleaning.join_wraps("foo\nbar\n\n# h\nx\ny\n\n```\na\nb\n```\n中\n文") == "foo bar\n\n# h\nx y\n\n```\na\nb\n```\n中文"
    assert cleaning.cut_repeat_plain("a " + "天地" * 100) == "a" and cleaning.cut_repeat_plain("天地玄黄" * 2) == "天地玄黄" * 2
    t, odd = cleaning.without_leaders(F.col("t"))
    assert one(spark, "a" + "." * 12 + "b", t) == "a b" and one(spark, "." * 200, odd) is True
    low, cut = cleaning.without_low_tail(F.col("t"))
    assert one(spark, "天地" * 100, cut) is True and one(spark, "天地" * 100, low) == "" and one(spark, "天地" * 10, cut) is False


def test_lines(spark):
    assert [one(spark, x, layout.join_lines(F.split("t", "\n"))) for x in ("foo\nbar", "中\n文", "foo,\nbar", "", "\n\n")] == ["foo bar", "中文", "foo,bar", "", ""]
    assert one(spark, "a\n1.2 Title\nb\nc", layout.block_text(F.split("t", "\n"))) == "a\n\n1.2 Title\n\nb c"
    assert one(spark, " 第12页 ", layout.margin_key(F.col("t"))) == "第<N>页" and one(spark, "- 十二 -", layout.is_page_number(F.col("t"))) and not one(spark, "12a", layout.is_page_number(F.col("t")))
    assert one(spark, "１．", layout.is_heading(F.col("t"))) is False and one(spark, "摘要", layout.is_heading(F.col("t"))) is True


def test_margins_and_blocks(spark):
    lines = spark.createDataFrame([("d", p, "Head 1") for p in range(3)] + [("d", 0, "once"), ("d", 0, "once"), ("d", 4, "twice"), ("d", 5, "twice")], "doc string, page int, line string")
    pages = spark.createDataFrame([("d", p) for p in range(10)], "doc string, page int")
    assert [(r.key, r.pages) for r in layout.repeated_margin_lines(lines, pages).collect()] == [("Head<N>", 3)]
    b = [(0.0, 0.0, 100.0, 10.0, "previous text long"), (0.0, 12.0, 100.0, 22.0, "x"), (0.0, 40.0, 100.0, 50.0, "far"), (11.0, 52.0, 100.0, 60.0, "indent"), (0.0, 62.0, 100.0, 70.0, "摘要")]
    df = spark.createDataFrame([("d", 1, i, *x) for i, x in enumerate(b)], "doc string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [r.island for r in layout.block_islands(df).orderBy("ord").collect()] == [1, 1, 2, 3, 4]
    assert layout.page_paragraphs(df).first().text == "previous text long x\n\nfar\n\nindent\n\n摘要"


def test_blank_pages(spark):
    h = spark.createDataFrame([(1, 255, 100), (2, 255, 99), (2, 0, 1)], "page int, gray int, count long")
    assert {r.page: r.blank for r in layout.blank_pages(h).collect()} == {1: True, 2: False}
