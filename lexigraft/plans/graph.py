"""Queries of graph operators over the stored tables, with their SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigraft.operators import agent, drafts, graph, reports, review, validate
from lexigraft.session import table
from lexigraft.sources.ontology import Ontology

TYPES = ("symptom", "disease", "formula", "herb", "drug", "therapy", "pattern", "tcm_disease", "marker", "acupoint", "meridian", "symptom_group")
ONTOLOGY = Ontology.of(
    {
        "entity_types": {t: {} for t in TYPES},
        "relation_types": {
            "treats": {"allowed_pairs": [["drug", "disease"], ["formula", "disease"], ["herb", "symptom"], ["therapy", "disease"], ["formula", "pattern"], ["drug", "symptom"]]},
            "produces": {"allowed_pairs": [["disease", "symptom"], ["pattern", "symptom"], ["herb", "marker"]]},
            "belongs_to": {"allowed_pairs": [["symptom", "symptom_group"], ["acupoint", "meridian"], ["disease", "disease"], ["herb", "formula"]]},
            "associated_with": {"allowed_pairs": [[a, b] for a in ("disease", "tcm_disease", "pattern") for b in ("symptom", "marker", "herb", "drug")]},
        },
    }
)
_RULES_SQL = "(VALUES " + ", ".join(f"('{r}', '{h}', '{t}')" for r, ps in ONTOLOGY.pairs.items() for h, t in sorted(ps)) + ") u(relation_type, head_type, tail_type)"
_TYPES_SQL = "(VALUES " + ", ".join(f"('{t}')" for t in TYPES) + ") k(entity_type)"


def entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities").select("id", "name", "entity_type", "source_id").distinct()


def relations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "relations").select("id", "subject_entity_id", "relation_type", "object_entity_id", "source_id").distinct()


def sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("source_id", "source_name", "text").distinct()


_E = "(SELECT DISTINCT id, name, entity_type, source_id FROM entities)"
_R = "(SELECT DISTINCT id, subject_entity_id, relation_type, object_entity_id, source_id FROM relations)"
_S = "(SELECT DISTINCT source_id, source_name, text FROM sources)"


def stored(spark, d):
    r = graph.source_results(sources(spark, d), entities(spark, d), relations(spark, d))
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["id"].cast("string")), ",").alias(c)
    return r.select("source_id", ids("entities"), ids("relations"))


def bad_entities(spark, d):
    e = entities(spark, d).select("source_id", F.col("id").alias("ord"), F.col("id").alias("item_id"), "name", "entity_type")
    return validate.entity_issues(e, ONTOLOGY.types_df(spark)).select("source_id", "code", "item_id")


def bad_relations(spark, d):
    r = relations(spark, d).select("source_id", F.col("id").alias("ord"), F.col("id").alias("item_id"), F.col("subject_entity_id").alias("subject_id"), "relation_type", F.col("object_entity_id").alias("object_id"))
    e = entities(spark, d).select("source_id", F.col("id").alias("item_id"), "entity_type").where(F.col("item_id") % 11 > 0)
    return validate.relation_issues(r, e, ONTOLOGY.rules_df(spark)).select("source_id", "code", "item_id")


_BAD_RELATIONS = f"""
WITH e AS (SELECT id, entity_type, source_id FROM {_E} WHERE id % 11 > 0),
r AS (SELECT r.*, s.id IS NULL OR o.id IS NULL lost, s.entity_type h, o.entity_type t FROM {_R} r
      LEFT JOIN e s ON s.id = r.subject_entity_id AND s.source_id = r.source_id LEFT JOIN e o ON o.id = r.object_entity_id AND o.source_id = r.source_id),
w AS (SELECT *, row_number() OVER (PARTITION BY source_id, subject_entity_id, relation_type, object_entity_id, lost ORDER BY id) rn FROM r)
SELECT source_id, 'MISSING_RELATION_ENTITY' code, id item_id FROM w WHERE lost
UNION ALL SELECT source_id, CASE WHEN relation_type IN (SELECT relation_type FROM {_RULES_SQL}) THEN 'RELATION_TYPE_MISMATCH' ELSE 'UNKNOWN_RELATION_TYPE' END, id FROM w
  WHERE NOT lost AND NOT EXISTS (SELECT 1 FROM {_RULES_SQL} WHERE u.relation_type = w.relation_type AND u.head_type = w.h AND u.tail_type = w.t)
UNION ALL SELECT source_id, 'DUPLICATE_RELATION', id FROM w WHERE NOT lost AND rn > 1
"""
_BLANK = r"NOT coalesce(regexp_matches(name, '[^\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'), false)"
_BAD_ENTITIES = f"""
WITH w AS (SELECT *, row_number() OVER (PARTITION BY source_id, name, entity_type ORDER BY id) rn FROM {_E})
SELECT source_id, 'EMPTY_NAME' code, id item_id FROM w WHERE {_BLANK}
UNION ALL SELECT source_id, 'UNKNOWN_ENTITY_TYPE', id FROM w WHERE entity_type IS NULL OR entity_type NOT IN (SELECT entity_type FROM {_TYPES_SQL})
UNION ALL SELECT source_id, 'DUPLICATE_ENTITY', id FROM w WHERE rn > 1
"""


def resolved(spark, d):
    n = graph.named_relations(relations(spark, d), entities(spark, d)).alias("n")
    e = entities(spark, d)
    s = e.select(F.col("id").alias("subject_entity_id"), F.col("entity_type").alias("subject_type"))
    o = e.select(F.col("id").alias("object_entity_id"), F.col("entity_type").alias("object_type"))
    r = n.join(s, "subject_entity_id").join(o, "object_entity_id")
    r = r.select("source_id", F.col("id").alias("ord"), F.col("subject_entity_name").alias("subject_name"), "subject_type", "relation_type", F.col("object_entity_name").alias("object_name"), "object_type")
    return graph.resolve_ends(r, e).select(F.col("ord").alias("id"), "subject_entity_id", "object_entity_id")


def commit_ids(spark, d):
    """New chunks of late sources get ids after those stored before, in order."""
    s = table(spark, d, "sources").groupBy("source_id").agg(F.min("committed_at").alias("at"))
    old = s.where(F.col("at") < F.lit("2025-01-03").cast("timestamp_ntz")).select("source_id")
    e = entities(spark, d)
    new = graph.uncommitted(e, old).select("source_id", F.col("id").alias("draft"))
    return graph.number_rows(new, ["source_id", "draft"], 1_000_001)


def skipped(spark, d):
    t = table(spark, d, "chunk_tasks").select("source_id", "relative_path", "chunk_index").distinct()
    return graph.already_committed(t, sources(spark, d))


def missing(spark, d):
    t = table(spark, d, "chunk_tasks").select("source_id", "relative_path", "chunk_index").distinct()
    return graph.uncommitted(t, sources(spark, d).where("source_name is not null"))


def _statuses(spark, d):
    t = table(spark, d, "chunk_tasks").select("source_id", F.col("relative_path").alias("file"), "chunk_index").distinct()
    s = sources(spark, d).groupBy("source_id").agg(F.max(F.col("text").isNotNull()).alias("has"), F.max(F.col("source_name").isNull()).alias("anon"))
    status = F.when(~F.coalesce("has", F.lit(False)), "failed").when(F.col("anon"), "max_steps_exceeded").when(F.col("chunk_index") == 0, "already_committed").otherwise("committed")
    return t.join(s, "source_id", "left").select("file", "chunk_index", "source_id", status.alias("status"))


_STATUS = """(SELECT t.relative_path file, t.chunk_index, t.source_id,
  CASE WHEN NOT coalesce(has, false) THEN 'failed' WHEN anon THEN 'max_steps_exceeded' WHEN chunk_index = 0 THEN 'already_committed' ELSE 'committed' END status
  FROM (SELECT DISTINCT source_id, relative_path, chunk_index FROM chunk_tasks) t
  LEFT JOIN (SELECT source_id, bool_or(text IS NOT NULL) has, bool_or(source_name IS NULL) anon FROM sources GROUP BY 1) s USING (source_id))"""


def summary(spark, d):
    return reports.run_summary(_statuses(spark, d))


def by_file(spark, d):
    r = reports.file_results(_statuses(spark, d))
    return r.select("file", F.array_join(F.transform("chunks", lambda x: F.concat_ws(":", x["chunk_index"].cast("string"), x["source_id"], x["status"])), ",").alias("chunks"))


def workspaces(spark, d):
    return reports.workspace_summary(sources(spark, d), entities(spark, d), relations(spark, d))


def _reviewed(spark, d):
    c = table(spark, d, "canonical_entities").groupBy(F.col("canon_name").alias("name")).agg(F.min("entity_type").alias("recommended_entity_type"), F.min("canon_id").alias("c"))
    e = entities(spark, d).where("name is not null").select("source_id", F.col("id").alias("ord"), "name", "entity_type")
    rev = e.select("source_id", "name").distinct().join(c, "name").select("source_id", "name", (F.col("c") % 7 > 0).alias("should_extract"), F.when(F.col("c") % 7 > 0, F.col("recommended_entity_type")).alias("recommended_entity_type"))
    return review.apply_reviews(e, rev)


_REVIEWED = f"""(SELECT e.source_id, e.id ord, e.name, e.entity_type, c % 7 > 0 should_extract, CASE WHEN c % 7 > 0 THEN rec END recommended_entity_type,
   coalesce(c % 7 > 0 AND rec IS NOT DISTINCT FROM e.entity_type, false) consistent,
   CASE WHEN c IS NULL THEN 'entity_type_review_missing' WHEN c % 7 = 0 THEN 'entity_not_extractable' WHEN rec IS DISTINCT FROM e.entity_type THEN 'entity_type' END kind
  FROM {_E} e LEFT JOIN (SELECT canon_name, min(entity_type) rec, min(canon_id) c FROM canonical_entities GROUP BY 1) k ON k.canon_name = e.name WHERE e.name IS NOT NULL)"""


def reviewed(spark, d):
    return _reviewed(spark, d).select("source_id", "ord", "name", "should_extract", "recommended_entity_type", "consistent", "kind")


def review_counts(spark, d):
    r = review.review_summary(_reviewed(spark, d))
    return r.select("source_id", "reviewed", "inconsistent", "not_extractable", F.array_join("not_extractable_names", "|").alias("names"))


def kinds(spark, d):
    return reports.error_histogram(_reviewed(spark, d).where("kind is not null").select(F.col("kind").alias("code")))


def pending(spark, d):
    e = entities(spark, d).where("name is not null").select("name", F.col("source_id").alias("context"), F.col("id").alias("ord"), F.col("id").alias("value"))
    cache = table(spark, d, "canonical_entities").select(F.col("canon_name").alias("name")).join(e.select("name", "context").distinct(), "name").where(F.crc32("context") % 2 == 0)
    return review.pending_requests(e, cache)


def batches(spark, d):
    e = entities(spark, d).select("source_id", F.col("id").alias("ord"))
    return review.batches_of(e, 5).groupBy("source_id", "batch").agg(F.count("*").alias("n"), F.min("ord").alias("first"))


def keys(spark, d):
    e = entities(spark, d).where("name is not null and source_id is not null")
    return e.select("id", review.review_key(F.col("name"), F.col("source_id")).alias("key"))


def warnings_in_order(spark, d):
    e = _reviewed(spark, d).where("kind is not null")
    n = F.row_number().over(Window.partitionBy("source_id").orderBy("ord"))
    w = e.withColumn("warning_id", F.concat(F.lit("w_"), n))
    return w.select("source_id", "warning_id", "kind", F.row_number().over(Window.partitionBy("source_id").orderBy("warning_id")).alias("place"), reports.compact_warning(["warning_id", "recommended_entity_type"]).alias("compact"))


def gate(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    out = validate.submit_gate(k % 5, k % 13 == 0, k % 4, F.when(k % 3 > 0, k % 4), k % 7, F.when(k % 2 == 0, k % 4), k % 6 % 2)
    return o.select("o_orderkey", out.alias("outcome"))


_GATE = """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'already_committed' WHEN o_orderkey % 5 > 0 THEN 'REVIEW_WARNINGS_PENDING'
 WHEN o_orderkey % 3 = 0 THEN 'CHUNK_NOT_VALIDATED' WHEN o_orderkey % 7 = 0 AND o_orderkey % 2 > 0 THEN 'EMPTY_CHUNK_NOT_CONFIRMED'
 WHEN o_orderkey % 6 % 2 > 0 THEN 'VALIDATION_FAILED' ELSE 'committed' END outcome FROM orders"""


def tool_groups(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("ord"), F.col("event_type").alias("tool"), (F.col("value") > 10).alias("ok"), F.col("event_id").cast("string").alias("result"))
    return reports.same_tool_groups(e).select("run", "grp", "tool", "ok", F.array_join("results", ",").alias("results"))


_TOOL_GROUPS = """
WITH s AS (SELECT user_id run, event_id ord, event_type tool, value > 10 ok, coalesce(lag(event_type) OVER w <> event_type, true) st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(CAST(st AS INTEGER)) OVER (PARTITION BY run ORDER BY ord) grp FROM s)
SELECT run, CAST(grp AS BIGINT) grp, tool, bool_and(ok) ok, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) results FROM g GROUP BY run, grp, tool
"""


def replayed(spark, d):
    """Every source's entities as calls to the draft machine: add, validate, submit."""
    e = table(spark, d, "entities").where("name is not null and entity_type is not null")
    add = e.select("source_id", F.struct("id", F.to_json(F.struct("name", "entity_type")).alias("arguments")).alias("add"))
    adds = add.groupBy("source_id").agg(F.sort_array(F.collect_set("add")).alias("adds"))  # a set: replayed rows count once
    texts = table(spark, d, "sources").where("source_id is not null").groupBy("source_id").agg(F.max("text").alias("text"))
    call = lambda n, tool, arguments=F.lit("{}"): F.struct(n.cast("int").alias("ord"), F.lit(tool).alias("tool"), arguments.alias("arguments"))
    some = F.coalesce("adds", F.array().cast(adds.schema["adds"].dataType))
    ends = F.array(*[call(F.size(some) + n, tool) for n, tool in enumerate(("validate_chunk", "submit_chunk"), 1)])
    calls = F.concat(F.transform(some, lambda x, n: call(n + 1, "add_entity", x["arguments"])), ends)
    return drafts.replay_chunks(texts.join(adds, "source_id", "left").select("source_id", "text", calls.alias("calls")), ONTOLOGY, trace=False)


def extracted(spark, d):
    """The agent with the offline client over every chunk: canonical names found in the text."""
    names = {r.canon_name: r.entity_type for r in table(spark, d, "canonical_entities").orderBy("canon_id").collect()}  # a reference list of fixed size
    s = sources(spark, d).select("source_id", "text").where("text is not null").dropDuplicates(["source_id"])
    out = agent.extract(s, ONTOLOGY, lambda: agent.Lexicon(names))
    return out.select("source_id", "status", "steps", "tool_calls", F.size("entities").alias("n"))


def flagship(spark, d):
    """The stored graph with named ends."""
    return graph.named_relations(relations(spark, d), entities(spark, d))


QUERIES = {
    "graph_sources": sources, "graph_entities": entities, "graph_export": flagship, "source_results": stored, "validate_entities": bad_entities, "validate_relations": bad_relations,
    "resolve_endpoints": resolved, "idempotent_commit": commit_ids, "resume_skipped": skipped, "resume_pending": missing, "run_summary": summary, "file_results": by_file,
    "workspace_summary": workspaces, "review_join": reviewed, "review_summary": review_counts, "error_histogram": kinds, "pending_reviews": pending, "review_batches": batches,
    "review_keys": keys, "warning_order": warnings_in_order, "gate_submit": gate, "tool_groups": tool_groups, "draft_replay": replayed, "agent_lexicon": extracted,
}
SQL = {
    "graph_sources": f"SELECT * FROM {_S}", "graph_entities": f"SELECT * FROM {_E}",
    "graph_export": f"SELECT r.id, r.subject_entity_id, s.name subject_entity_name, r.relation_type, r.object_entity_id, o.name object_entity_name, r.source_id FROM {_R} r JOIN {_E} s ON s.id = r.subject_entity_id JOIN {_E} o ON o.id = r.object_entity_id",
    "source_results": f"""SELECT source_id, coalesce(e, '') entities, coalesce(r, '') relations FROM (SELECT DISTINCT source_id FROM sources)
      LEFT JOIN (SELECT source_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) e FROM {_E} GROUP BY 1) USING (source_id)
      LEFT JOIN (SELECT source_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) r FROM {_R} GROUP BY 1) USING (source_id)""",
    "validate_entities": _BAD_ENTITIES, "validate_relations": _BAD_RELATIONS,
    "resolve_endpoints": f"""WITH k AS (SELECT source_id, name, entity_type, min(id) id FROM {_E} GROUP BY 1, 2, 3),
      n AS (SELECT r.id, r.source_id, s.name sn, s.entity_type st, o.name oname, o.entity_type ot FROM {_R} r JOIN {_E} s ON s.id = r.subject_entity_id JOIN {_E} o ON o.id = r.object_entity_id)
      SELECT n.id, a.id subject_entity_id, b.id object_entity_id FROM n JOIN k a ON a.source_id = n.source_id AND a.name = sn AND a.entity_type = st JOIN k b ON b.source_id = n.source_id AND b.name = oname AND b.entity_type = ot""",
    "idempotent_commit": f"""WITH old AS (SELECT source_id FROM sources GROUP BY 1 HAVING min(committed_at) < TIMESTAMP '2025-01-03'),
      n AS (SELECT source_id, id draft FROM {_E} WHERE source_id NOT IN (SELECT source_id FROM old)) SELECT source_id, draft, 1000000 + row_number() OVER (ORDER BY source_id, draft) id FROM n""",
    "resume_skipped": "SELECT DISTINCT source_id, relative_path, chunk_index FROM chunk_tasks WHERE source_id IN (SELECT source_id FROM sources)",
    "resume_pending": "SELECT DISTINCT source_id, relative_path, chunk_index FROM chunk_tasks t WHERE NOT EXISTS (SELECT 1 FROM sources s WHERE s.source_id = t.source_id AND source_name IS NOT NULL)",
    "run_summary": f"SELECT count(DISTINCT file) files, count(*) chunks, count(*) FILTER (status = 'committed') committed, count(*) FILTER (status = 'already_committed') skipped, count(*) FILTER (status = 'failed') failed, count(*) FILTER (status NOT IN ('committed', 'already_committed')) incomplete FROM {_STATUS}",
    "file_results": f"SELECT file, string_agg(concat_ws(':', chunk_index, source_id, status), ',' ORDER BY chunk_index, source_id) chunks FROM {_STATUS} GROUP BY 1",
    "workspace_summary": f"""SELECT source_id, coalesce(e, 0) entity_count, coalesce(r, 0) relation_count FROM (SELECT DISTINCT source_id FROM sources)
      LEFT JOIN (SELECT source_id, count(*) e FROM {_E} GROUP BY 1) USING (source_id) LEFT JOIN (SELECT source_id, count(*) r FROM {_R} GROUP BY 1) USING (source_id)""",
    "review_join": f"SELECT source_id, ord, name, should_extract, recommended_entity_type, consistent, kind FROM {_REVIEWED}",
    "review_summary": f"""SELECT source_id, count(*) FILTER (kind IS NULL OR kind <> 'entity_type_review_missing') reviewed, count(*) FILTER ((kind IS NULL OR kind <> 'entity_type_review_missing') AND NOT consistent) inconsistent,
      count(*) FILTER (kind = 'entity_not_extractable') not_extractable, coalesce(string_agg(name, '|' ORDER BY ord) FILTER (kind = 'entity_not_extractable'), '') names FROM {_REVIEWED} GROUP BY 1""",
    "error_histogram": f"SELECT kind code, count(*) n FROM {_REVIEWED} WHERE kind IS NOT NULL GROUP BY 1",
    "review_batches": f"SELECT source_id, CAST(floor((rn - 1) / 5) AS INTEGER) batch, count(*) n, min(id) first FROM (SELECT source_id, id, row_number() OVER (PARTITION BY source_id ORDER BY id) rn FROM {_E}) GROUP BY 1, 2",
    "review_keys": f"SELECT id, sha256(concat(name, chr(0), source_id)) \"key\" FROM {_E} WHERE name IS NOT NULL AND source_id IS NOT NULL",
    "warning_order": f"""WITH w AS (SELECT source_id, kind, recommended_entity_type r, 'w_' || row_number() OVER (PARTITION BY source_id ORDER BY ord) warning_id FROM {_REVIEWED} WHERE kind IS NOT NULL)
      SELECT source_id, warning_id, kind, CAST(row_number() OVER (PARTITION BY source_id ORDER BY warning_id) AS INTEGER) place,
      '{{"warning_id":"' || warning_id || '"' || coalesce(',"recommended_entity_type":"' || r || '"', '') || '}}' compact FROM w""",
    "gate_submit": _GATE, "tool_groups": _TOOL_GROUPS,
}
