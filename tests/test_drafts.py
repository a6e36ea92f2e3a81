import json
import types
import unicodedata

import pytest

from lexigraft.operators import agent, evidence
from lexigraft.operators.drafts import REPLAY_SCHEMA, Draft, replay
from lexigraft.operators.evidence import evidence_error, name_form
from lexigraft.operators.protocol import ACTION, THOUGHT, json_lines, parse_actions, parse_reviews, tools_for, wrong_arguments
from lexigraft.plans import graph
from lexigraft.sources.ontology import Ontology, cache_namespace

O = Ontology.of({"entity_types": {"症状": {}, "病": {}, "症状群": {}}, "relation_types": {"has": {"allowed_pairs": [["病", "症状"]]}}})
TEXT = "感冒者胸闷、气 短，ＡＢ。"


def code(r):
    return None if r["ok"] else r["error"]["code"]


def test_ontology(tmp_path):
    with pytest.raises(ValueError):
        Ontology.of({"entity_types": {}, "relation_types": {}})
    with pytest.raises(ValueError):
        Ontology.of({"entity_types": {"a": {"x": 1}}, "relation_types": {}})
    with pytest.raises(ValueError):
        Ontology.of({"entity_types": {"a": {}}, "relation_types": {"r": {"allowed_pairs": [["a", "b"]]}}})
    assert cache_namespace(None, "m") == "model:m"
    p = tmp_path / "n.json"
    p.write_text(json.dumps({"model_namespaces": {"m": "", "k": "ns"}}))
    assert (cache_namespace(str(p), "m"), cache_namespace(str(p), "k")) == ("model:m", "ns")


def test_names_and_evidence():
    assert name_form(" a | b ", "症状群") == "a|b" and name_form(" a | b ", "症状") == "a | b"
    assert evidence_error("气短", "症状", TEXT) is None and evidence_error("AB", "症状", TEXT) is None
    assert evidence_error("胸闷|气短", "症状群", TEXT) is None and evidence_error("胸闷|​", "症状群", TEXT) is None
    for bad in ("胸闷", "胸闷|", "胸闷|胸闷", "胸闷|咳嗽"):
        assert evidence_error(bad, "症状群", TEXT)
    assert evidence_error("", "症状", TEXT) and evidence_error("咳嗽", "症状", TEXT)


def test_editing_and_gates():
    d = Draft("s", TEXT, O)
    assert code(d.submit_chunk()) == "CHUNK_NOT_VALIDATED"
    assert code(d.add_entity(" ", "症状")) == "EMPTY_NAME" and code(d.add_entity("胸闷", "x")) == "UNKNOWN_ENTITY_TYPE" and code(d.add_entity("咳嗽", "症状")) == "INVALID_EVIDENCE"
    assert d.add_entity("胸闷", "症状") == {"ok": True, "entity_id": "e_1", "status": "created"} and d.add_entity("胸闷", "症状")["status"] == "existing"
    d.add_entity("感冒", "病")
    ends = dict(subject_entity_name="感冒", subject_entity_type="病", relation_type="has", object_entity_name="胸闷", object_entity_type="症状")
    assert code(d.add_relation(**(ends | {"relation_type": "no"}))) == "UNKNOWN_RELATION_TYPE"
    d.warn("entity_type:e_1", {"kind": "entity_type", "entity_id": "e_1"})
    assert code(d.add_relation(**ends)) == "ENTITY_TYPE_REVIEW_PENDING" and code(d.confirm_review_warning("w_1", "short")) == "REVIEW_REASON_TOO_SHORT"
    assert code(d.confirm_review_warning("w_9", "long enough reason")) == "REVIEW_WARNING_NOT_FOUND" and d.confirm_review_warning("w_1", "long enough reason")["ok"]
    assert d.add_relation(**ends)["relation_id"] == "r_1" and d.add_relation(**ends)["status"] == "existing"
    assert code(d.delete_entity("e_1")) == "ENTITY_IN_USE" and code(d.update_entity("e_1", {"z": 1})) == "INVALID_PATCH"
    assert d.validate_chunk()["valid"] and d.update_relation("r_1", {})["ok"] and code(d.submit_chunk()) == "CHUNK_NOT_VALIDATED"
    d.validate_chunk()
    again = Draft.from_json(d.to_json(), O)
    assert again.submit_chunk()["status"] == "committed" and again.submit_chunk()["status"] == "already_committed" and code(again.add_entity("胸闷", "症状")) == "CHUNK_COMMITTED"


def test_empty_chunks_and_warning_order():
    d = Draft("s", TEXT, O)
    d.validate_chunk()
    assert code(d.submit_chunk()) == "EMPTY_CHUNK_NOT_CONFIRMED" and code(d.confirm_empty_chunk("no")) == "EMPTY_REASON_TOO_SHORT"
    d.confirm_empty_chunk("nothing here")
    assert d.submit_chunk()["ok"]
    w = Draft("s", TEXT, O)
    for i in range(10):
        w.warn(str(i), {})
    assert [x["warning_id"] for x in w.list_review_warnings()["warnings"]][:3] == ["w_1", "w_10", "w_2"]


def test_protocol():
    got = [(n, c) for n, _, c, _ in json_lines('{"a":1}\n\n[1]\n{x')]
    assert got == [(1, None), (2, "EMPTY_JSONL_LINE"), (3, "INVALID_JSON_OBJECT"), (4, "INVALID_JSON")] and [c for _, _, c, _ in json_lines("")] == ["EMPTY_JSONL"]
    assert parse_actions("x")[0] == [] and parse_actions(f"{ACTION}{THOUGHT}a")[1] and parse_actions(f"{THOUGHT}{ACTION}")[1]
    a, e = parse_actions(f'{THOUGHT}t{ACTION}{{"tool":"validate_chunk"}}\n{{"tool":""}}\n{{"tool":"x","z":1}}\nno')
    assert a == [("validate_chunk", {})] and len(e) == 3
    for args, want in (({"name": "x"}, "MISSING_ARGUMENT"), ({"name": "x", "entity_type": "t", "y": 1}, "UNKNOWN_ARGUMENT"), ({"name": 1, "entity_type": "t"}, "INVALID_ARGUMENT_TYPE"), ([], "INVALID_ARGUMENTS")):
        assert wrong_arguments("add_entity", args)["error"]["code"] == want
    assert wrong_arguments("nope", {})["error"]["code"] == "UNKNOWN_TOOL"
    assert wrong_arguments("add_entity", {"name": "x", "entity_type": "q"}, tools_for(O.types, O.pairs))["error"]["code"] == "INVALID_ARGUMENT_VALUE"
    row = {"reason": "r ", "name": "n", "should_extract": True, "recommended_entity_type": "病", "confidence": 0.165}
    ok, errors = parse_reviews("\n".join(json.dumps(x) for x in (row, row, row | {"name": "m", "confidence": 2}, row | {"name": "m", "should_extract": False})), ["n", "m"], O.types)
    assert ok["n"]["confidence"] == round(0.165, 2) and [x["code"] for x in errors] == ["UNKNOWN_OR_DUPLICATE_REVIEW", "INVALID_REVIEW_CONFIDENCE", "UNEXPECTED_RECOMMENDED_TYPE", "MISSING_ENTITY_REVIEW"]


def test_replay_and_agent(spark):
    calls = [("a", TEXT, 1, "add_entity", json.dumps({"name": "胸闷", "entity_type": "症状"})), ("a", TEXT, 2, "validate_chunk", None), ("a", TEXT, 3, "submit_chunk", "{}"), ("b", None, 1, "add_entity", '{"name": "x"}')]
    rows = replay(spark.createDataFrame(calls, "source_id string, text string, ord int, tool string, arguments string"), O).collect()
    assert {(r.source_id, r.ord): (r.ok, r.code) for r in rows} == {("a", 1): (True, None), ("a", 2): (True, None), ("a", 3): (True, None), ("b", 1): (False, "MISSING_ARGUMENT")}
    chunks = spark.createDataFrame([("a", TEXT), ("b", "无"), ("c", None)], "source_id string, text string")
    out = {r.source_id: r for r in agent.extract(chunks, O, lambda: agent.Lexicon({"胸闷": "症状"})).collect()}
    assert [out[k].status for k in "abc"] == ["committed"] * 3 and out["a"].entities[0].name == "胸闷"

    class Broken:
        def complete(self, messages):
            raise RuntimeError("down")

    assert {r.status for r in agent.extract(chunks, O, Broken).collect()} == {"failed"}


def test_agent_steps_and_review():
    turn = lambda *c: f"{THOUGHT}t{ACTION}" + "\n".join(json.dumps({"tool": t, "arguments": a}, ensure_ascii=False) for t, a in c)
    d = Draft("s", TEXT, O)
    review = json.dumps({"reason": "ok", "name": "胸闷", "should_extract": True, "recommended_entity_type": "病", "confidence": 0.9}, ensure_ascii=False)
    asked = agent.Replay(["", review])
    run = agent.run_chunk(
        d,
        agent.Replay([turn(("add_entity", {"name": "胸闷", "entity_type": "症状"}), ("submit_chunk", {})), "noise", turn(("update_entity", {"entity_id": "e_1", "patch": {"name": "x"}}), ("submit_chunk", {})), turn(("confirm_review_warning", {"warning_id": "w_1", "reason": "it stays as it is"}), ("validate_chunk", {}), ("submit_chunk", {}))]),
        agent.Reviewer(asked, O),
    )
    assert run["status"] == "committed" and run["steps"] == 4 and run["parse_errors"] == 2
    assert agent.run_chunk(Draft("s", TEXT, O), agent.Replay([]), max_steps=2)["status"] == "max_steps_exceeded"
    assert agent.run_chunk(Draft("s", TEXT, O, committed=True), agent.Replay([]))["status"] == "already_committed"
    assert agent.context_of("x" * 500 + "胸闷" + "y" * 500, "胸闷") == "x" * 160 + "胸闷" + "y" * 160 and agent.context_of("abc", "q") == ""


def test_text_is_folded_once_a_draft(monkeypatch):
    folded = []
    monkeypatch.setattr(evidence, "unicodedata", types.SimpleNamespace(normalize=lambda form, t: folded.append(t) or unicodedata.normalize(form, t), category=unicodedata.category))
    d = Draft("s", TEXT, O)
    assert [d.add_entity(n, "症状")["ok"] for n in ("胸闷", "气短", "AB", "咳嗽")] == [True, True, True, False]
    assert d.validate_chunk()["valid"] and d.submit_chunk()["ok"] and folded.count(TEXT) == 1
    assert evidence.comparable("\u200bＡ\u00ad \u3000b\x1f\U000e0001c") == "Abc"


def test_replay_without_trace(spark):
    add = lambda n: json.dumps({"name": n, "entity_type": "症状"}, ensure_ascii=False)
    calls = [(3, "submit_chunk", "{}"), (1, "add_entity", add("胸闷")), (2, "validate_chunk", None), (4, "no_tool", "{}")]
    rows = [(f"c{i}", TEXT if i % 3 else None, *c) for i in range(700) for c in calls]
    df = spark.createDataFrame(rows, "source_id string, text string, ord int, tool string, arguments string").coalesce(1)
    full, bare = replay(df, O), replay(df, O, trace=False)
    assert full.schema.simpleString() == spark.createDataFrame([], REPLAY_SCHEMA).schema.simpleString() and bare.columns == full.columns[:5]
    want = {}
    for i in range(700):
        d = Draft(f"c{i}", TEXT if i % 3 else "", O)
        for n, tool, args in sorted(calls):
            r = d.call(tool, json.loads(args or "{}"))
            want[d.source_id, n] = (tool, r["ok"], code(r), json.dumps(r, ensure_ascii=False), d.to_json())
    assert {(r.source_id, r.ord): tuple(r[2:]) for r in full.collect()} == want
    got = bare.collect()
    assert len(got) == len(want) and {(r.source_id, r.ord): tuple(r[2:]) for r in got} == {k: v[:3] for k, v in want.items()}
    assert replay(df.where("false"), O).count() == 0


def test_draft_replay_of_odd_tables(spark, tmp_path):
    """Late and replayed rows, sources without text, entity or id, entities without a source: each text moves once, by chunk."""
    sources = [("a", "f", None), ("a", "g", "fever and rash"), ("a", "g", "fever and rash"), ("b", "f", None), ("c", "f", "fever"), (None, "f", "fever")]
    entities = [(12, "rash", "symptom", "a"), (2, "fever", "disease", "a"), (2, "fever", "disease", "a"), (3, 'no "x"\n', "disease", "a"), (4, "fever", "kind", "a"), (5, "fever", "disease", "a"), (6, None, "disease", "a"), (7, "fever", None, "a"), (8, "fever", "disease", "b"), (9, "fever", "disease", "lost"), (10, "fever", "disease", None)]
    spark.createDataFrame(sources, "source_id string, source_name string, text string").write.parquet(str(tmp_path / "sources.parquet"))
    spark.createDataFrame(entities, "id long, name string, entity_type string, source_id string").write.parquet(str(tmp_path / "entities.parquet"))
    df = graph.QUERIES["draft_replay"](spark, str(tmp_path))
    short = {"add_entity": "add", "validate_chunk": "validate", "submit_chunk": "submit"}
    got = sorted((r.source_id, r.ord, short[r.tool], r.code) for r in df.collect())
    empty = "EMPTY_CHUNK_NOT_CONFIRMED"
    assert got == [
        *(("a", n, "add", c) for n, c in enumerate((None, "INVALID_EVIDENCE", "UNKNOWN_ENTITY_TYPE", None, None), 1)), ("a", 6, "validate", None), ("a", 7, "submit", None),
        ("b", 1, "add", "INVALID_EVIDENCE"), ("b", 2, "validate", None), ("b", 3, "submit", empty), ("c", 1, "validate", None), ("c", 2, "submit", empty),
    ]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and "Window" not in plan and plan.count("Aggregate [") == 2
