"""Queries of the core problems over the project's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigraft.operators.nested import dewey_nodes, flat_table, prune_leaves
from lexigraft.operators.packed import packed_fields, unpack_values
from lexigraft.session import table

ROOTS = ["ExternalReferenceList", "SynonymList", "SummaryInformationList"]
CHILDREN = {
    "ExternalReferenceList.ExternalReference": "external_reference",
    "ExternalReferenceList.ExternalReference.DisorderMappingRelation": "mapping_relation",
    "SynonymList.Synonym": "synonym",
    "SummaryInformationList.SummaryInformation": "summary",
    "SummaryInformationList.SummaryInformation.TextSectionList.TextSection": "text_section",
}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = table(spark, sf_dir, "disease_alignment_en").schema
    df = table(spark, sf_dir, "disease_alignment_en", prune_leaves(full, "id", ROOTS))
    n = dewey_nodes(df, "id", ROOTS, keep=set(CHILDREN))
    name = F.create_map(*[F.lit(x) for kv in CHILDREN.items() for x in kv])
    return n.select("id", name[F.col("schema_path")].alias("child"), F.col("dewey").alias("path")).distinct()


def _p1_table(path: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, "disease_alignment_en")
        return flat_table(df, "id", path)

    return run


PACKED = {"disease": ("McId", {"Aliases": False, "ExternalIds": True}), "disease_en": ("id", {"synonym_ls": False, "external_id_ls": True})}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [packed_fields(table(spark, sf_dir, t), t, key, cols) for t, (key, cols) in PACKED.items()]
    return unpack_values(fields[0].unionByName(fields[1])).distinct()


_P1_SQL = """
WITH d AS (SELECT id, ExternalReferenceList e, SynonymList s, SummaryInformationList m FROM disease_alignment_en),
e1 AS (SELECT id, i, e[i + 1] w FROM d, unnest(range(len(e))) t(i) WHERE e[i + 1] IS NOT NULL),
e2 AS (SELECT id, i, j, w.ExternalReference[j + 1] r FROM e1, unnest(range(len(w.ExternalReference))) t(j)
       WHERE w.ExternalReference[j + 1] IS NOT NULL),
e3 AS (SELECT id, i, j, k FROM e2, unnest(range(len(r.DisorderMappingRelation))) t(k)
       WHERE r.DisorderMappingRelation[k + 1] IS NOT NULL),
s1 AS (SELECT id, i, s[i + 1] w FROM d, unnest(range(len(s))) t(i) WHERE s[i + 1] IS NOT NULL),
s2 AS (SELECT id, i, j FROM s1, unnest(range(len(w.Synonym))) t(j) WHERE w.Synonym[j + 1] IS NOT NULL),
m1 AS (SELECT id, i, m[i + 1] w FROM d, unnest(range(len(m))) t(i) WHERE m[i + 1] IS NOT NULL),
m2 AS (SELECT id, i, j, w.SummaryInformation[j + 1] x FROM m1, unnest(range(len(w.SummaryInformation))) t(j)
       WHERE w.SummaryInformation[j + 1] IS NOT NULL),
m3 AS (SELECT id, i, j, k, x.TextSectionList[k + 1] l FROM m2, unnest(range(len(x.TextSectionList))) t(k)
       WHERE x.TextSectionList[k + 1] IS NOT NULL),
m4 AS (SELECT id, i, j, k, n FROM m3, unnest(range(len(l.TextSection))) t(n) WHERE l.TextSection[n + 1] IS NOT NULL)
SELECT DISTINCT * FROM (
  SELECT id, 'external_reference' child, concat_ws('.', i, j) path FROM e2
  UNION ALL SELECT id, 'mapping_relation', concat_ws('.', i, j, k) FROM e3
  UNION ALL SELECT id, 'synonym', concat_ws('.', i, j) FROM s2
  UNION ALL SELECT id, 'summary', concat_ws('.', i, j) FROM m2
  UNION ALL SELECT id, 'text_section', concat_ws('.', i, j, k, n) FROM m4)
"""

_P1_REFERENCES_SQL = """
WITH d AS (SELECT DISTINCT id, i, ExternalReferenceList[i + 1] w FROM disease_alignment_en, unnest(range(len(ExternalReferenceList))) t(i)),
e AS (SELECT id, i, j, w.ExternalReference[j + 1] r FROM d, unnest(range(len(w.ExternalReference))) t(j))
SELECT DISTINCT id, concat('ExternalReferenceList.', i, '.', j) node, concat('ExternalReferenceList.', i) parent,
       r.id id_value, r.Source "Source", r.Reference "Reference" FROM e WHERE r IS NOT NULL
"""

_P1_SECTIONS_SQL = """
WITH a AS (SELECT id, i, SummaryInformationList[i + 1] w FROM disease_alignment_en, unnest(range(len(SummaryInformationList))) t(i)),
b AS (SELECT id, i, j, w.SummaryInformation[j + 1] x FROM a, unnest(range(len(w.SummaryInformation))) t(j)),
c AS (SELECT id, i, j, k, x.TextSectionList[k + 1] l FROM b, unnest(range(len(x.TextSectionList))) t(k)),
e AS (SELECT id, i, j, k, n, l.TextSection[n + 1] s FROM c, unnest(range(len(l.TextSection))) t(n))
SELECT DISTINCT id, concat('SummaryInformationList.', concat_ws('.', i, j, k, n)) node,
       concat('SummaryInformationList.', concat_ws('.', i, j, k)) parent, s.id id_value, s.lang lang, s.Contents "Contents"
FROM e WHERE s IS NOT NULL
"""

_P1_SYNONYMS_SQL = """
WITH d AS (SELECT id, i, SynonymList[i + 1] w FROM disease_alignment_en, unnest(range(len(SynonymList))) t(i)),
e AS (SELECT id, i, j, w.Synonym[j + 1] r FROM d, unnest(range(len(w.Synonym))) t(j))
SELECT DISTINCT id, concat('SynonymList.', i, '.', j) node, concat('SynonymList.', i) parent, r.lang lang, r.label AS label FROM e WHERE r IS NOT NULL
"""

_P1_RELATIONS_SQL = """
WITH d AS (SELECT id, i, ExternalReferenceList[i + 1] w FROM disease_alignment_en, unnest(range(len(ExternalReferenceList))) t(i)),
e AS (SELECT id, i, j, w.ExternalReference[j + 1] r FROM d, unnest(range(len(w.ExternalReference))) t(j)),
f AS (SELECT id, i, j, k, r.DisorderMappingRelation[k + 1] m FROM e, unnest(range(len(r.DisorderMappingRelation))) t(k))
SELECT DISTINCT id, concat('ExternalReferenceList.', concat_ws('.', i, j, k)) node, concat('ExternalReferenceList.', concat_ws('.', i, j)) parent, m.id id_value FROM f WHERE m IS NOT NULL
"""

_P1_SUMMARIES_SQL = """
WITH d AS (SELECT id, i, SummaryInformationList[i + 1] w FROM disease_alignment_en, unnest(range(len(SummaryInformationList))) t(i)),
e AS (SELECT id, i, j, w.SummaryInformation[j + 1] r FROM d, unnest(range(len(w.SummaryInformation))) t(j))
SELECT DISTINCT id, concat('SummaryInformationList.', i, '.', j) node, concat('SummaryInformationList.', i) parent, r.id id_value, r.lang lang FROM e WHERE r IS NOT NULL
"""

_W = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
_N = _W[1:-1]
_Q = r'"(?:[^"\\]|\\.|"")*"|\\.'
_P3_SQL = rf"""
WITH f AS (
  SELECT 'disease.Aliases' field, McId record_id, false ids, Aliases p FROM disease
  UNION ALL SELECT 'disease.ExternalIds', McId, true, ExternalIds FROM disease
  UNION ALL SELECT 'disease_en.synonym_ls', id, false, synonym_ls FROM disease_en
  UNION ALL SELECT 'disease_en.external_id_ls', id, true, external_id_ls FROM disease_en),
g AS (SELECT DISTINCT field, record_id, ids, regexp_replace(regexp_replace(p, '^{_W}+', ''), '{_W}+$', '') p FROM f),
h AS (SELECT *, regexp_replace(p, '{_W}/{_W}', chr(1), 'g') q,
             regexp_matches(p, '^\[.*\]$', 's') AND json_valid(p) js FROM g WHERE p <> ''),
o AS (SELECT *, regexp_replace(q, '{_Q}', '', 'g') bare FROM h),
v AS (SELECT field, record_id,
        CASE WHEN js THEN from_json(p, '["VARCHAR"]')
             WHEN ids THEN regexp_extract_all(q, '(?:{_Q}|[^"\\|;；、,{_N}])+')
             WHEN regexp_matches(bare, '[|;；、\n\r\t\x01]') THEN regexp_extract_all(q, '(?:{_Q}|[^"\\|;；、\n\r\t\x01])+')
             ELSE regexp_extract_all(q, '(?:{_Q}|[^"\\,])+') END l, js FROM o),
w AS (SELECT field, record_id, js, replace(regexp_replace(regexp_replace(x, '^{_W}+', ''), '{_W}+$', ''), chr(1), ' / ') x, n
      FROM (SELECT field, record_id, js, unnest(l) x, unnest(range(len(l))) n FROM v)),
y AS (SELECT field, record_id, n, CASE WHEN js THEN x
        WHEN regexp_matches(x, '^".*"$', 's') THEN regexp_replace(regexp_replace(replace(x[2:-2], '""', '"'), '^{_W}+', ''), '{_W}+$', '')
        ELSE regexp_replace(x, '\\(.)', '\1', 'g') END val FROM w)
SELECT field, record_id, CAST(row_number() OVER (PARTITION BY field, record_id ORDER BY n) - 1 AS INTEGER) pos, val
FROM y WHERE val <> ''
"""

QUERIES = {
    "p1_found": p1_found,
    "p1_references": _p1_table("ExternalReferenceList.ExternalReference"),
    "p1_sections": _p1_table("SummaryInformationList.SummaryInformation.TextSectionList.TextSection"),
    "p1_synonyms": _p1_table("SynonymList.Synonym"),
    "p1_mapping_relations": _p1_table("ExternalReferenceList.ExternalReference.DisorderMappingRelation"),
    "p1_summaries": _p1_table("SummaryInformationList.SummaryInformation"),
    "p3_found": p3_found,
}
SQL = {"p1_found": _P1_SQL, "p1_references": _P1_REFERENCES_SQL, "p1_sections": _P1_SECTIONS_SQL, "p1_synonyms": _P1_SYNONYMS_SQL, "p1_mapping_relations": _P1_RELATIONS_SQL, "p1_summaries": _P1_SUMMARIES_SQL, "p3_found": _P3_SQL}
