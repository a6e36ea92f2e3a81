"""Queries of text operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.functions.text import WS, strip_ws
from lexigraft.operators import cleaning, layout
from lexigraft.operators.chunks import chunk_documents, content_id
from lexigraft.operators.evidence import entity_name, evidence_error_udf
from lexigraft.operators.protocol import register
from lexigraft.operators.review import local_context
from lexigraft.session import table

_N = WS[1:-1]
_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sources").select("source_id", "text").distinct()


def chunks(spark, sf_dir):
    return chunk_documents(_docs(spark, sf_dir), "doc_id", "text", "docs", F.concat(F.lit("doc_"), F.col("doc_id")))


_CHUNKS = f"""
WITH n AS (SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i chunk_index, substring(t, i * 900 + 1, 1000) text FROM n,
      unnest(range(CASE WHEN length(t) <= 1000 THEN 1 ELSE CAST(ceil((length(t) - 100) / 900.0) AS INTEGER) END)) u(i))
SELECT doc_id, CAST(chunk_index AS INTEGER) chunk_index,
       sha256(concat('docs:doc_', doc_id, '#chunk_', chunk_index, chr(0), text)) source_id, text
FROM w WHERE regexp_matches(text, '[^{_N}]')
"""


def source_ids(spark, sf_dir):
    t = table(spark, sf_dir, "chunk_tasks").select("source_id", "source_name", "relative_path").distinct()
    made = t.join(_sources(spark, sf_dir), "source_id")
    made = made.withColumn("made", content_id(F.col("relative_path"), F.col("source_name"), F.coalesce("text", F.lit(""))))
    return made.groupBy((F.col("made") == F.col("source_id")).alias("same")).agg(F.count("*").alias("n"))


_SOURCE_IDS = """
WITH t AS (SELECT DISTINCT source_id, source_name, relative_path FROM chunk_tasks), s AS (SELECT DISTINCT source_id, text FROM sources)
SELECT sha256(concat(relative_path, chr(0), coalesce(text, ''))) = source_id same, count(*) n FROM t JOIN s USING (source_id) GROUP BY 1
"""


def entity_names(spark, sf_dir):
    e = table(spark, sf_dir, "entities").select("id", "name", "entity_type").distinct()
    return e.select("id", entity_name(F.col("name"), F.coalesce("entity_type", F.lit(""))).alias("stored"))


def evidence(spark, sf_dir):
    e = table(spark, sf_dir, "entities").select("id", "name", "entity_type", "source_id").where("name is not null").distinct()
    j = e.join(_sources(spark, sf_dir), "source_id")
    return j.select("id", evidence_error_udf("name", F.coalesce("entity_type", F.lit("")), "text").alias("error"))


def contexts(spark, sf_dir):
    e = table(spark, sf_dir, "entities").select("id", "name", "source_id").where("name is not null and length(name) > 0").distinct()
    return e.join(_sources(spark, sf_dir).where("text is not null"), "source_id").select("id", local_context(F.col("text"), F.col("name")).alias("context"))


_CONTEXTS = """
WITH e AS (SELECT DISTINCT id, name, source_id FROM entities WHERE name IS NOT NULL AND length(name) > 0),
s AS (SELECT DISTINCT source_id, text FROM sources WHERE text IS NOT NULL),
p1 AS (SELECT id, name, text, length(name) n, strpos(text, name) a FROM e JOIN s USING (source_id)),
p2 AS (SELECT *, CASE WHEN a > 0 AND strpos(substring(text, a + n), name) > 0 THEN a + n - 1 + strpos(substring(text, a + n), name) ELSE 0 END b FROM p1),
p3 AS (SELECT *, CASE WHEN b > 0 AND strpos(substring(text, b + n), name) > 0 THEN b + n - 1 + strpos(substring(text, b + n), name) ELSE 0 END c FROM p2),
q AS (SELECT id, list_filter([a, b, c], lambda x: x > 0) ps, text, n FROM p3),
r AS (SELECT id, list_transform(ps, lambda p: substring(text, greatest(p - 160, 1), n + 160 + least(p - 1, 160))) l FROM q)
SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10) || '…' || chr(10)) context FROM r
"""


def leaders(spark, sf_dir):
    t, odd = cleaning.without_leaders(F.col("text"))
    return _docs(spark, sf_dir).where("text is not null").select("doc_id", t.alias("text"), odd.alias("abnormal"))


_LEAD = rf"(?:[・·\.．…]{WS}*){{12,}}"
_LEADERS = f"SELECT doc_id, regexp_replace(text, '{_LEAD}', ' ', 'g') text, length(regexp_extract(text, '{_LEAD}', 0)) >= 200 abnormal FROM documents WHERE text IS NOT NULL"


def low_tails(spark, sf_dir):
    t, cut = cleaning.without_low_tail(F.col("text"))
    return _docs(spark, sf_dir).where("text is not null").select("doc_id", F.length(t).alias("n"), cut.alias("cut"))


_LOW_TAILS = r"""
WITH h AS (SELECT doc_id, length(text) n, regexp_extract_all(text, '[\x{3400}-\x{9fff}]') han FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, n, len(han) >= 160 AND len(list_distinct(han[-160:])) <= 6 cut FROM h)
SELECT doc_id, CAST(CASE WHEN cut THEN greatest(n - 320, 0) ELSE n END AS INTEGER) n, cut FROM k
"""


def tags(spark, sf_dir):
    d = _docs(spark, sf_dir).where("text is not null")
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<|ref|>title<|/ref|> <|det|>[[1,2,3,4]]<|/det|>"), "text")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Table [[1, 2, 3, 4]] "), "text", F.lit("<|endofsentence|>"))).otherwise(F.col("text"))
    t, tagged = cleaning.without_tags(marked)
    return d.select("doc_id", F.md5(t).alias("md5"), tagged.alias("tagged"))


_TAGS = """
SELECT doc_id, md5(CASE doc_id % 3 WHEN 1 THEN ' ' || text ELSE text END) md5, doc_id % 3 < 2 tagged FROM documents WHERE text IS NOT NULL
"""


def tidy(spark, sf_dir):
    return _docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(cleaning.tidy_blanks(F.col("text"))).alias("md5"))


_TIDY = "SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[ \t]+\n', '\n', 'g'), '\n{3,}', '\n\n', 'g')) md5 FROM documents WHERE text IS NOT NULL"


def joined_lines(spark, sf_dir):
    s = _sources(spark, sf_dir).where("text is not null")
    return s.select("source_id", F.md5(layout.join_lines(F.split("text", "\n"))).alias("md5"))


_JOINED = f"""
WITH l AS (SELECT source_id, unnest(string_split(text, chr(10))) x, generate_subscripts(string_split(text, chr(10)), 1) i FROM (SELECT DISTINCT source_id, text FROM sources WHERE text IS NOT NULL)),
k AS (SELECT source_id, i, {_STRIP('x')} x FROM l), f AS (SELECT source_id, i, x, lag(x) OVER (PARTITION BY source_id ORDER BY i) p FROM k WHERE x <> ''),
j AS (SELECT source_id, string_agg(CASE WHEN regexp_matches(p, '[0-9A-Za-z]$') AND regexp_matches(x, '^[0-9A-Za-z]') THEN ' ' || x ELSE x END, '' ORDER BY i) t FROM f GROUP BY 1)
SELECT s.source_id, md5(coalesce(t, '')) md5 FROM (SELECT DISTINCT source_id FROM sources WHERE text IS NOT NULL) s LEFT JOIN j USING (source_id)
"""


def line_kinds(spark, sf_dir):
    x = F.explode(F.split("text", "\n")).alias("line")
    l = _sources(spark, sf_dir).where("text is not null").select("source_id", x).where(strip_ws(F.col("line")) != "")
    kind = F.when(layout.is_page_number(F.col("line")), "page_number").when(layout.is_heading(F.col("line")), "heading").otherwise("body")
    return l.groupBy("source_id", kind.alias("kind")).agg(F.count("*").alias("n"))


_KINDS = rf"""
WITH l AS (SELECT source_id, {_STRIP('line')} s, line FROM (SELECT source_id, unnest(string_split(text, chr(10))) line FROM (SELECT DISTINCT source_id, text FROM sources WHERE text IS NOT NULL)))
SELECT source_id, CASE WHEN regexp_matches(line, '^(?:{WS}|[-—–·])*[0-9一二三四五六七八九十百千〇○]+(?:{WS}|[-—–·])*$') THEN 'page_number'
  WHEN length(s) <= 50 AND (s IN ('摘要', 'Abstract', '参考文献', '关键词', 'Key words') OR regexp_matches(s, '^\p{{Nd}}+(?:\.\p{{Nd}}+)*{WS}+[^{_N}]')) THEN 'heading' ELSE 'body' END kind, count(*) n
FROM l WHERE s <> '' GROUP BY 1, 2
"""


def repeat_cut(spark, sf_dir):
    return cleaning.clean_pages(_docs(spark, sf_dir).select("doc_id", "text"), "text")


def plain_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", cleaning.clean_plain("text").alias("text"))


def block_lines(spark, sf_dir):
    return _sources(spark, sf_dir).select("source_id", layout.block_text(F.split("text", "\n")).alias("text"))


def decoded_lines(spark, sf_dir):
    register(spark)
    t = _docs(spark, sf_dir).where("text is not null")
    t.createOrReplaceTempView("lexigraft_texts")
    return spark.sql("SELECT doc_id, line, payload, code FROM lexigraft_texts, LATERAL json_lines(text)")


def encoded(spark, sf_dir):
    return _docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "[\r\n]", "")).alias("md5"))


QUERIES = {
    "chunk_documents": chunks, "source_ids": source_ids, "entity_names": entity_names, "evidence_errors": evidence, "local_context": contexts,
    "dot_leaders": leaders, "han_tail": low_tails, "layout_tags": tags, "tidy_blanks": tidy, "joined_lines": joined_lines, "line_kinds": line_kinds,
    "repeat_truncate": repeat_cut, "plain_clean": plain_clean, "block_sections": block_lines, "jsonl_decode": decoded_lines, "base64_text": encoded,
}
SQL = {
    "chunk_documents": _CHUNKS, "source_ids": _SOURCE_IDS,
    "entity_names": f"""SELECT id, CASE WHEN entity_type = '症状群' THEN array_to_string(list_transform(string_split({_STRIP('name')}, '|'), lambda x: {_STRIP('x')}), '|') ELSE {_STRIP('name')} END stored FROM (SELECT DISTINCT id, name, entity_type FROM entities)""",
    "local_context": _CONTEXTS, "dot_leaders": _LEADERS, "han_tail": _LOW_TAILS, "layout_tags": _TAGS, "tidy_blanks": _TIDY, "joined_lines": _JOINED, "line_kinds": _KINDS,
    "base64_text": "SELECT doc_id, md5(base64(encode(text))) md5 FROM documents WHERE text IS NOT NULL",
}
