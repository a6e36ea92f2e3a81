"""Page layout: blocks of text with coordinates to reading text, and page classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigraft.functions.text import WS, strip_ws

# fixed values: thresholds of page classification, normal and strict
NORMAL = {"text_pages": 0.80, "full_images": 0.10, "fullwidth": 0.10, "private": 0.0005, "replacement": 1.0, "blocks": 60.0}
STRICT = {"text_pages": 0.98, "full_images": 0.0, "fullwidth": 0.03, "private": 0.0, "replacement": 0.0, "blocks": 40.0}
#: fixed values: parts of reader warnings
UNSAFE = ("invalid key in dict", "expected object number", "cannot find object", "object out of range", "invalid xref")
MIN_PAGE_CHARS, FULL_IMAGE, MARGIN = 50, 0.75, 0.10
HEADINGS = ("摘要", "Abstract", "参考文献", "关键词", "Key words")
OPENINGS = ("摘要", "关键词", "Abstract", "Key words", "Funding", "参考文献", "基金项目", "通信作者")


def margin_key(line: Column) -> Column:
    """A margin line without white space, numbers as ``<N>``."""
    return F.regexp_replace(F.regexp_replace(strip_ws(line), r"\p{Nd}+", "<N>"), f"{WS}+", "")


def in_margin(y0: Column, y1: Column, height: Column, ratio: float = MARGIN) -> Column:
    return (y1 <= height * ratio) | (y0 >= height * (1 - ratio))


def is_page_number(line: Column) -> Column:
    return line.rlike(rf"^(?:{WS}|[-—–·])*[0-9一二三四五六七八九十百千〇○]+(?:{WS}|[-—–·])*$")


def is_heading(line: Column) -> Column:
    s = strip_ws(line)
    numbered = s.rlike(rf"^\p{{Nd}}+(?:\.\p{{Nd}}+)*{WS}+[^{WS[1:-1]}]")
    return (F.length(s) <= 50) & (s.isin(*HEADINGS) | numbered)


def repeated_margin_lines(lines: DataFrame, pages: DataFrame | None = None, share: float = 0.30) -> DataFrame:
    """(doc, key, pages): margin lines on at least ``max(2, ceil(share * pages))`` pages of a document.

    ``lines``: (doc, page, line) of margins only; ``pages``: (doc, page), all pages of each document.
    Two partial aggregates; the page counts join on the document.
    """
    total = (pages if pages is not None else lines.select("doc", "page")).distinct().groupBy("doc").agg(F.count("*").alias("total"))
    k = lines.select("doc", "page", margin_key(F.col("line")).alias("key")).where("key <> ''").distinct()
    n = k.groupBy("doc", "key").agg(F.count("*").alias("pages"))
    return n.join(total, "doc").where(F.col("pages") >= F.greatest(F.lit(2), F.ceil(F.col("total") * F.lit(share)))).select("doc", "key", "pages")


def merges(prev: dict[str, Column], cur: dict[str, Column]) -> Column:
    """True where a block continues the one before it."""
    gap = cur["y0"] - prev["y1"]
    over = F.greatest(F.lit(0.0), F.least(prev["x1"], cur["x1"]) - F.greatest(prev["x0"], cur["x0"]))
    width = F.greatest(F.lit(1.0), F.least(prev["x1"] - prev["x0"], cur["x1"] - cur["x0"]))
    opens = F.lit(False)
    for o in OPENINGS:
        opens = opens | cur["text"].startswith(o)
    return gap.between(-1, 8) & (over / width >= 0.60) & (cur["x0"] <= prev["x0"] + 10) & ~opens & (F.length(prev["text"]) > 12)


def joined(a: Column, b: Column) -> Column:
    """Two pieces of a paragraph: a blank between ASCII letters or digits only."""
    return F.concat(a, F.when(a.rlike("[0-9A-Za-z]$") & b.rlike("^[0-9A-Za-z]"), " ").otherwise(""), b)


def join_lines(lines: Column) -> Column:
    """Lines of one paragraph as running text; blank lines are left out."""
    kept = F.filter(F.transform(lines, strip_ws), lambda x: x != "")
    return F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), F.coalesce(F.get(kept, F.lit(0)), F.lit("")), joined)


def block_islands(blocks: DataFrame) -> DataFrame:
    """Blocks with ``island``: the number of the paragraph they belong to on their page.

    ``blocks``: (doc, page, ord, x0, y0, x1, y1, text). One window per page.
    """
    w = Window.partitionBy("doc", "page").orderBy("ord")
    b = blocks.withColumn("__p", F.lag(F.struct("x0", "x1", "y1", "text")).over(w))
    prev = {c: F.col("__p")[c] for c in ("x0", "x1", "y1", "text")}
    cur = {c: F.col(c) for c in ("x0", "x1", "y0", "text")}
    start = ~F.coalesce(merges(prev, cur), F.lit(False))
    return b.withColumn("island", F.sum(start.cast("int")).over(w)).drop("__p")


def page_paragraphs(blocks: DataFrame) -> DataFrame:
    """(doc, page, text): islands joined inside, separated by blank lines."""
    i = block_islands(blocks).groupBy("doc", "page", "island").agg(F.sort_array(F.collect_list(F.struct("ord", "text"))).alias("b"))
    texts = F.transform("b", lambda x: x["text"])
    i = i.withColumn("p", F.aggregate(F.slice(texts, F.lit(2), F.size(texts)), F.get(texts, F.lit(0)), joined))
    p = i.groupBy("doc", "page").agg(F.sort_array(F.collect_list(F.struct("island", "p"))).alias("ps"))
    return p.select("doc", "page", strip_ws(F.regexp_replace(F.array_join(F.transform("ps", lambda x: x["p"]), "\n\n"), "\n{3,}", "\n\n")).alias("text"))


def block_text(lines: Column) -> Column:
    """Lines of one block: headings stand alone, the rest is joined between them."""
    kept = F.filter(F.transform(lines, strip_ws), lambda x: x != "")
    # the accumulator holds finished sections and the open paragraph
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, x: Column) -> Column:
        flushed = F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        more = F.when(acc["open"] == "", x).otherwise(joined(acc["open"], x))
        return F.when(is_heading(x), F.struct(F.array_append(flushed, x).alias("done"), F.lit("").alias("open"))).otherwise(F.struct(acc["done"].alias("done"), more.alias("open")))

    end = lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
    return F.array_join(F.aggregate(kept, start, step, end), "\n\n")


def native_pages(blocks: DataFrame) -> DataFrame:
    """(doc, page, text) of text-layer blocks: margins cleaned, wraps merged.

    ``blocks``: (doc, page, page_height, ord, x0, y0, x1, y1, text, block_type). Margin lines are
    learned from all pages given.
    """
    b = blocks.where("block_type = 0").withColumn("m", in_margin(F.col("y0"), F.col("y1"), F.col("page_height"))).withColumn("ls", F.split("text", "\n"))
    margin = b.where("m").select("doc", "page", F.explode("ls").alias("line"))
    furniture = repeated_margin_lines(margin, blocks.select("doc", "page")).groupBy("doc").agg(F.collect_set("key").alias("keys"))
    b = b.join(furniture, "doc", "left")
    gone = lambda x: F.col("m") & (F.coalesce(F.array_contains("keys", margin_key(x)), F.lit(False)) | is_page_number(strip_ws(x)))
    kept = b.withColumn("text", block_text(F.filter("ls", lambda x: ~gone(x)))).where("text <> ''")
    return page_paragraphs(kept.select("doc", "page", "ord", "x0", "y0", "x1", "y1", "text"))


def native_stats(pages: DataFrame) -> DataFrame:
    """Per document: character classes, text pages, image pages and the median of text blocks.

    ``pages``: (doc, page, text, text_blocks, max_image_coverage).
    """
    t = F.regexp_replace("text", f"{WS}+", "")
    p = pages.select("doc", "text_blocks", "max_image_coverage", F.length(t).alias("c"), *[F.regexp_count(t, F.lit(r)).alias(n) for n, r in (("fw", r"[\x{ff01}-\x{ff5e}]"), ("pu", r"[\x{e000}-\x{f8ff}]"), ("rc", r"\x{fffd}"))])
    a = p.groupBy("doc").agg(
        F.count("*").alias("total_pages"), F.count_if(F.col("c") >= MIN_PAGE_CHARS).alias("text_pages"), F.count_if(F.col("max_image_coverage") >= FULL_IMAGE).alias("full_image_pages"),
        F.sum("c").alias("chars"), F.sum("fw").alias("fw"), F.sum("pu").alias("pu"), F.sum("rc").alias("rc"), F.median("text_blocks").alias("median_text_blocks"),
    )
    per = lambda c: F.col(c) / F.greatest("chars", F.lit(1))
    return a.select(
        "doc", "total_pages", "text_pages", "full_image_pages", "chars", "median_text_blocks",
        (F.col("text_pages") / F.col("total_pages")).alias("text_page_ratio"), (F.col("full_image_pages") / F.col("total_pages")).alias("full_image_page_ratio"),
        per("fw").alias("fullwidth_ratio"), per("pu").alias("private_ratio"), per("rc").alias("replacement_ratio"),
    )


def is_native(limits: dict[str, float] = NORMAL) -> Column:
    """The decision over ``native_stats``."""
    return (
        (F.col("text_page_ratio") >= limits["text_pages"]) & (F.col("full_image_page_ratio") <= limits["full_images"]) & (F.col("fullwidth_ratio") <= limits["fullwidth"])
        & (F.col("private_ratio") <= limits["private"]) & (F.col("replacement_ratio") <= limits["replacement"]) & (F.col("median_text_blocks") <= limits["blocks"])
    )


def image_coverage(images: DataFrame) -> DataFrame:
    """(doc, page, max_image_coverage): largest share of the page one image covers, at most 1.

    ``images``: (doc, page, width, height, x0, y0, x1, y1).
    """
    w = F.greatest(F.lit(0.0), F.least("x1", "width") - F.greatest("x0", F.lit(0.0)))
    h = F.greatest(F.lit(0.0), F.least("y1", "height") - F.greatest("y0", F.lit(0.0)))
    area = F.col("width") * F.col("height")
    share = F.when(area > 0, F.least(F.lit(1.0), w * h / area)).otherwise(0.0)
    return images.groupBy("doc", "page").agg(F.max(share).alias("max_image_coverage"))


def blank_pages(hist: DataFrame) -> DataFrame:
    """(page, ink_ratio, contrast, blank) from grey histograms (page, gray, count)."""
    w = Window.partitionBy("page")
    h = hist.withColumn("total", F.sum("count").over(w)).withColumn("cum", F.sum("count").over(w.orderBy("gray")))
    h = h.withColumn("bg", F.min(F.when(F.col("cum") >= F.col("total") * 0.9, F.col("gray"))).over(w))
    h = h.withColumn("mean", F.sum(F.col("gray") * F.col("count")).over(w) / F.col("total"))
    ink = F.sum(F.when(F.col("gray") < F.greatest(F.lit(0), F.col("bg") - 25), F.col("count")).otherwise(0)) / F.first("total")
    spread = F.sqrt(F.sum((F.col("gray") - F.col("mean")) ** 2 * F.col("count")) / F.first("total"))
    a = h.groupBy("page").agg(ink.alias("ink_ratio"), spread.alias("contrast"))
    return a.withColumn("blank", (F.col("ink_ratio") < 0.0015) & (F.col("contrast") < 8.0))


def page_document(pages: DataFrame) -> DataFrame:
    """(doc, text): pages in order, each under its heading."""
    p = pages.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("page", "text"))).alias("ps"))
    return p.select("doc", F.array_join(F.transform("ps", lambda x: F.concat(F.lit("## 第 "), x["page"].cast("string"), F.lit(" 页\n\n"), x["text"], F.lit("\n\n"))), "").alias("text"))


def unsafe_warning(message: Column) -> Column:
    """Reader warnings after which native text is not trusted (case does not matter)."""
    m = F.lower(message)
    hit = F.lit(False)
    for part in UNSAFE:
        hit = hit | m.contains(part)
    return hit
