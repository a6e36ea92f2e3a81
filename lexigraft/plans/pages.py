"""Queries of layout operators, with their SQL. Geometry comes from lineitem columns, pages from chunk_tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigraft.operators import layout
from lexigraft.plans.text import _STRIP
from lexigraft.session import table


def _pages(spark, d):
    t = table(spark, d, "chunk_tasks").select("source_id", F.col("relative_path").alias("doc"), F.col("chunk_index").alias("page")).distinct()
    s = table(spark, d, "sources").groupBy("source_id").agg(F.max("text").alias("text"))
    return t.join(s, "source_id").where("text is not null")


_PAGES = """(SELECT DISTINCT t.source_id, relative_path doc, chunk_index page, text FROM chunk_tasks t
  JOIN (SELECT source_id, max(text) text FROM sources GROUP BY 1) s ON s.source_id = t.source_id WHERE text IS NOT NULL)"""


def margin_lines(spark, d):
    ls = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x)) > 0)
    p = _pages(spark, d).select("doc", "page", ls.alias("ls"))
    edge = p.select("doc", "page", F.explode(F.array_compact(F.array(F.get("ls", F.lit(0)), F.get("ls", F.size("ls") - 1)))).alias("line"))
    return layout.repeated_margin_lines(edge, p.select("doc", "page"))


_MARGINS = rf"""
WITH p AS (SELECT doc, page, list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) > 0) ls FROM {_PAGES}),
e AS (SELECT doc, page, unnest([ls[1], ls[-1]]) line FROM p),
k AS (SELECT DISTINCT doc, page, regexp_replace(regexp_replace({_STRIP('line')}, '\p{{Nd}}+', '<N>', 'g'), '[\x{{9}}-\x{{d}}\x{{1c}}-\x{{20}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}-\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', '', 'g') "key" FROM e WHERE line IS NOT NULL),
n AS (SELECT doc, count(DISTINCT page) total FROM p GROUP BY 1)
SELECT doc, "key", pages FROM (SELECT doc, "key", count(*) pages FROM k WHERE "key" <> '' GROUP BY 1, 2) JOIN n USING (doc) WHERE pages >= greatest(2, ceil(total * 0.30::DOUBLE))
"""


def _stat_pages(spark, d):
    return _pages(spark, d).select("doc", "text", (F.col("page") % 5 + 1).alias("text_blocks"), F.when(F.col("page") % 9 == 0, 0.8).otherwise(0.1).alias("max_image_coverage"))


def native_stats(spark, d):
    s = layout.native_stats(_stat_pages(spark, d))
    return s.select("doc", "total_pages", "text_pages", "full_image_pages", "chars", "median_text_blocks", *[F.round(c, 9).alias(c) for c in ("text_page_ratio", "full_image_page_ratio", "fullwidth_ratio", "private_ratio", "replacement_ratio")])


_W = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
_STATS = rf"""
WITH p AS (SELECT doc, page % 5 + 1 blocks, CASE WHEN page % 9 = 0 THEN 0.8 ELSE 0.1 END cov, regexp_replace(text, '{_W}+', '', 'g') t FROM {_PAGES}),
c AS (SELECT doc, blocks, cov, length(t) c, length(t) - length(regexp_replace(t, '[\x{{ff01}}-\x{{ff5e}}]', '', 'g')) fw, length(t) - length(regexp_replace(t, '[\x{{e000}}-\x{{f8ff}}]', '', 'g')) pu, length(t) - length(replace(t, chr(65533), '')) rc FROM p),
a AS (SELECT doc, count(*) n, count(*) FILTER (c >= 50) tp, count(*) FILTER (cov >= 0.75) fi, CAST(sum(c) AS BIGINT) chars, median(blocks) m, greatest(sum(c), 1) den, sum(fw) fw, sum(pu) pu, sum(rc) rc FROM c GROUP BY 1)
SELECT doc, n total_pages, tp text_pages, fi full_image_pages, chars, CAST(m AS DOUBLE) median_text_blocks, round(tp / n, 9) text_page_ratio, round(fi / n, 9) full_image_page_ratio,
  round(fw / den, 9) fullwidth_ratio, round(pu / den, 9) private_ratio, round(rc / den, 9) replacement_ratio FROM a
"""


def native_decision(spark, d):
    return layout.native_stats(_stat_pages(spark, d)).select("doc", layout.is_native().alias("native"), layout.is_native(layout.STRICT).alias("strict"))


_DECISION = f"""WITH s AS ({_STATS}) SELECT doc, text_page_ratio >= 0.8 AND full_image_page_ratio <= 0.1 AND fullwidth_ratio <= 0.1 AND private_ratio <= 0.0005 AND median_text_blocks <= 60 native,
 text_page_ratio >= 0.98 AND full_image_page_ratio <= 0 AND fullwidth_ratio <= 0.03 AND private_ratio <= 0 AND replacement_ratio <= 0 AND median_text_blocks <= 40 strict FROM s"""


def _boxes(spark, d):
    l = table(spark, d, "lineitem")
    x0, y0 = (F.col("l_quantity") % 3) * 6, F.col("l_linenumber") * F.lit(12.0) + F.col("l_quantity") % 4
    return l.select(
        (F.col("l_orderkey") % 1000).alias("doc"), F.col("l_orderkey").alias("page"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("ord"),
        x0.alias("x0"), y0.alias("y0"), (x0 + 50 + F.col("l_quantity")).alias("x1"), (y0 + 8).alias("y1"), F.concat_ws(" ", F.lit("block"), "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("text"),
    )


_BOXES = """(SELECT l_orderkey % 1000 doc, l_orderkey page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) rn, l_quantity % 3 * 6 x0, l_linenumber * 12.0::DOUBLE + l_quantity % 4 y0,
  l_quantity % 3 * 6 + 50 + l_quantity x1, l_linenumber * 12.0::DOUBLE + l_quantity % 4 + 8 y1, concat_ws(' ', 'block', l_returnflag, l_linestatus, l_partkey) text FROM lineitem)"""


def block_islands(spark, d):
    return layout.block_islands(_boxes(spark, d)).groupBy("doc", "page", "island").agg(F.count("*").alias("blocks"), F.min("y0").alias("top"))


_ISLANDS = f"""
WITH b AS (SELECT *, lag(x0) OVER w px0, lag(x1) OVER w px1, lag(y1) OVER w py1, lag(text) OVER w pt FROM {_BOXES} WINDOW w AS (PARTITION BY doc, page ORDER BY rn)),
m AS (SELECT *, coalesce(y0 - py1 BETWEEN -1 AND 8 AND greatest(0, least(px1, x1) - greatest(px0, x0)) / greatest(1, least(px1 - px0, x1 - x0)) >= 0.6 AND x0 <= px0 + 10 AND length(pt) > 12, false) mg FROM b),
i AS (SELECT *, sum(CASE WHEN mg THEN 0 ELSE 1 END) OVER (PARTITION BY doc, page ORDER BY rn) island FROM m)
SELECT doc, page, CAST(island AS BIGINT) island, count(*) blocks, min(y0) top FROM i GROUP BY 1, 2, 3
"""


def page_paragraphs(spark, d):
    return layout.page_paragraphs(_boxes(spark, d))


_PARAGRAPHS = _ISLANDS.split("SELECT doc, page, CAST")[0] + """, p AS (SELECT doc, page, island, string_agg(text, ' ' ORDER BY rn) t FROM i GROUP BY 1, 2, 3)
SELECT doc, page, string_agg(t, chr(10) || chr(10) ORDER BY island) text FROM p GROUP BY 1, 2"""


def native_pages(spark, d):
    b = _boxes(spark, d).withColumn("page_height", F.lit(90.0)).withColumn("block_type", F.when(F.col("x0") > 6, 1).otherwise(0))
    return layout.native_pages(b)


def image_coverage(spark, d):
    l = table(spark, d, "lineitem")
    img = l.select((F.col("l_orderkey") % 1000).alias("doc"), F.col("l_orderkey").alias("page"), F.lit(60.0).alias("width"), F.lit(80.0).alias("height"), (F.col("l_quantity") - 10).alias("x0"), (F.col("l_tax") * 100 - 4).alias("y0"), (F.col("l_quantity") * 2).alias("x1"), (F.col("l_discount") * 1000).alias("y1"))
    return layout.image_coverage(img).select("doc", "page", F.round("max_image_coverage", 9).alias("coverage"))


_COVERAGE = """SELECT l_orderkey % 1000 doc, l_orderkey page, round(max(least(1.0, greatest(0, least(l_quantity * 2, 60) - greatest(l_quantity - 10, 0)) * greatest(0, least(l_discount * 1000, 80) - greatest(l_tax * 100 - 4, 0)) / 4800)), 9) coverage FROM lineitem GROUP BY 1, 2"""


def _hist(spark, d):
    l = table(spark, d, "lineitem")
    gray = F.when(F.col("l_orderkey") % 3 == 0, 250 + F.col("l_quantity") % 5).otherwise(F.col("l_quantity") * 5).cast("int")
    return l.groupBy(F.col("l_orderkey").alias("page"), gray.alias("gray")).agg(F.count("*").alias("count"))


def blank_pages(spark, d):
    return layout.blank_pages(_hist(spark, d)).select("page", F.round("ink_ratio", 9).alias("ink_ratio"), F.round("contrast", 6).alias("contrast"), "blank")


_BLANK = """
WITH h AS (SELECT l_orderkey page, CAST(CASE WHEN l_orderkey % 3 = 0 THEN 250 + l_quantity % 5 ELSE l_quantity * 5 END AS INTEGER) gray, count(*) c FROM lineitem GROUP BY 1, 2),
t AS (SELECT page, sum(c) total, sum(gray * c) / sum(c) mean FROM h GROUP BY 1),
k AS (SELECT page, gray, sum(c) OVER (PARTITION BY page ORDER BY gray) cum FROM h),
b AS (SELECT k.page, min(gray) bg FROM k JOIN t USING (page) WHERE cum >= total * 0.9 GROUP BY 1),
a AS (SELECT h.page, sum(CASE WHEN gray < greatest(0, bg - 25) THEN c ELSE 0 END) / any_value(total) ink, sqrt(sum((gray - mean) ** 2 * c) / any_value(total)) sd FROM h JOIN t USING (page) JOIN b USING (page) GROUP BY 1)
SELECT page, round(ink, 9) ink_ratio, round(sd, 6) contrast, ink < 0.0015 AND sd < 8 blank FROM a
"""


def page_documents(spark, d):
    return layout.page_document(_pages(spark, d).select("doc", (F.col("page") + 1).alias("page"), "text")).select("doc", F.md5("text").alias("md5"))


_DOCUMENTS = f"SELECT doc, md5(string_agg('## 第 ' || (page + 1) || ' 页' || chr(10) || chr(10) || text || chr(10) || chr(10), '' ORDER BY page)) md5 FROM {_PAGES} GROUP BY 1"


def unsafe_warnings(spark, d):
    m = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("MuPDF: "), F.when(F.col("o_orderkey") % 4 == 0, "Cannot Find Object 7").when(F.col("o_orderkey") % 4 == 1, "invalid XREF").otherwise("font substituted")).alias("m"))
    return m.select("o_orderkey", layout.unsafe_warning(F.col("m")).alias("unsafe"))


QUERIES = {
    "margin_lines": margin_lines, "native_stats": native_stats, "native_decision": native_decision, "block_islands": block_islands, "page_paragraphs": page_paragraphs, "native_pages": native_pages,
    "image_coverage": image_coverage, "blank_pages": blank_pages, "page_documents": page_documents, "unsafe_warnings": unsafe_warnings,
}
SQL = {
    "margin_lines": _MARGINS, "native_stats": _STATS, "native_decision": _DECISION, "block_islands": _ISLANDS, "page_paragraphs": _PARAGRAPHS, "image_coverage": _COVERAGE, "blank_pages": _BLANK,
    "page_documents": _DOCUMENTS, "unsafe_warnings": "SELECT o_orderkey, o_orderkey % 4 < 2 unsafe FROM orders",
}
