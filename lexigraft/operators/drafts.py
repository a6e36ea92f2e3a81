"""The editable draft graph of one chunk, its tools and their replay over many chunks.

Edits depend on order (each may be refused because of the ones before), so one chunk is one small
state machine. ``replay`` runs recorded calls for many chunks with one row per chunk; the same
machine serves the agent and the streaming form.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigraft.operators.evidence import comparable, name_form, support_error
from lexigraft.operators.protocol import fail, ok, wrong_arguments
from lexigraft.sources.ontology import Ontology

BLOCKING = ("entity_type", "entity_not_extractable", "entity_type_review_missing")
_REL = ("subject_entity_name", "subject_entity_type", "relation_type", "object_entity_name", "object_entity_type")


class Draft:
    """State of a chunk and one method per tool; every method answers with a dict."""

    def __init__(self, source_id: str, text: str, ontology: Ontology, source_name: str = "", committed: bool = False):
        self.source_id, self.source_name, self.text, self.ontology, self.committed = source_id, source_name, text, ontology, committed
        self.entities: dict[str, dict] = {}
        self.relations: dict[str, dict] = {}
        self.warnings: dict[str, dict] = {}
        self.seq = {"e": 0, "r": 0, "w": 0}
        self.revision, self.validated, self.emptied, self.empty_reason = 0, None, None, None

    # state ---------------------------------------------------------------------------------------
    def to_json(self) -> str:
        keep = ("source_id", "source_name", "text", "committed", "entities", "relations", "warnings", "seq", "revision", "validated", "emptied", "empty_reason")
        return json.dumps({k: getattr(self, k) for k in keep}, ensure_ascii=False)

    @classmethod
    def from_json(cls, raw: str, ontology: Ontology) -> "Draft":
        d = cls("", "", ontology)
        d.__dict__.update(json.loads(raw))
        return d

    def _new(self, kind: str) -> str:
        self.seq[kind] += 1
        return f"{kind}_{self.seq[kind]}"

    def _changed(self) -> None:
        self.revision += 1
        self.validated = self.emptied = self.empty_reason = None

    def _find(self, name: str, kind: str) -> dict | None:
        return next((e for e in self.entities.values() if e["name"] == name and e["entity_type"] == kind), None)

    def warn(self, key: str, warning: dict) -> dict:
        """Set the warning of a key; a key keeps its warning's id."""
        wid = self.warnings[key]["warning_id"] if key in self.warnings else self._new("w")
        self.warnings[key] = warning | {"warning_id": wid}
        return self.warnings[key]

    def _clear(self, entity_id: str) -> None:
        self.warnings = {k: w for k, w in self.warnings.items() if w.get("entity_id") != entity_id}

    @cached_property
    def _body(self) -> str:
        return comparable(self.text)  # a draft's text stays as it is: folded once for all its names

    def _lacking(self, name: str, kind: str) -> str | None:
        return support_error(name, kind, self._body)

    # reading -------------------------------------------------------------------------------------
    def get_chunk_context(self) -> dict:
        return ok(text=self.text)

    def get_workspace_summary(self) -> dict:
        return ok(entity_count=len(self.entities), relation_count=len(self.relations), committed=self.committed)

    def list_entities(self, entity_id: str | None = None) -> dict:
        if entity_id is not None and entity_id not in self.entities:
            return fail("ENTITY_NOT_FOUND")
        return ok(entities=[dict(e) for i, e in self.entities.items() if entity_id in (None, i)])

    def list_relations(self, relation_id: str | None = None) -> dict:
        if relation_id is not None and relation_id not in self.relations:
            return fail("RELATION_NOT_FOUND")
        return ok(relations=[self._named(r) for i, r in self.relations.items() if relation_id in (None, i)])

    def list_review_warnings(self) -> dict:
        w = sorted(self.warnings.values(), key=lambda w: w["warning_id"])  # as text: w_10 before w_2
        return ok(warnings=w, warning_count=len(w))

    def _named(self, r: dict) -> dict:
        s, o = self.entities[r["subject"]], self.entities[r["object"]]
        return {"relation_id": r["relation_id"], **dict(zip(_REL, (s["name"], s["entity_type"], r["predicate"], o["name"], o["entity_type"])))}

    # entities ------------------------------------------------------------------------------------
    def _entity_error(self, name: str, kind: str) -> dict | None:
        if not name:
            return fail("EMPTY_NAME")
        if kind not in self.ontology.types:
            return fail("UNKNOWN_ENTITY_TYPE", kind)
        lacking = self._lacking(name, kind)
        return fail("INVALID_EVIDENCE", lacking) if lacking else None

    def add_entity(self, name: str, entity_type: str) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        name = name_form(name, entity_type)
        if error := self._entity_error(name, entity_type):
            return error
        if same := self._find(name, entity_type):
            return ok(entity_id=same["entity_id"], status="existing")
        i = self._new("e")
        self.entities[i] = {"entity_id": i, "name": name, "entity_type": entity_type}
        self._changed()
        return ok(entity_id=i, status="created")

    def update_entity(self, entity_id: str, patch: dict) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        e = self.entities.get(entity_id)
        if e is None:
            return fail("ENTITY_NOT_FOUND")
        if extra := sorted(set(patch) - {"name", "entity_type"}):
            return fail("INVALID_PATCH", str(extra))
        kind = str(patch.get("entity_type", e["entity_type"]))
        name = name_form(str(patch.get("name", e["name"])), kind)
        if error := self._entity_error(name, kind):
            return error
        other = self._find(name, kind)
        if other is not None and other is not e:
            return fail("DUPLICATE_ENTITY", entity_id=other["entity_id"])
        moved = (name, kind) != (e["name"], e["entity_type"])
        if moved:
            self._clear(entity_id)
        e.update(name=name, entity_type=kind)
        self._changed()
        return ok(entity_id=entity_id, name=name, entity_type=kind, identity_changed=moved, status="updated")

    def delete_entity(self, entity_id: str) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        if entity_id not in self.entities:
            return fail("ENTITY_NOT_FOUND")
        if used := [i for i, r in self.relations.items() if entity_id in (r["subject"], r["object"])]:
            return fail("ENTITY_IN_USE", related_relation_ids=used)
        self._clear(entity_id)
        del self.entities[entity_id]
        self._changed()
        return ok(entity_id=entity_id, status="deleted")

    # relations -----------------------------------------------------------------------------------
    def _ends(self, want: dict) -> tuple[dict | None, dict | None, dict | None]:
        s = self._find(want["subject_entity_name"], want["subject_entity_type"])
        o = self._find(want["object_entity_name"], want["object_entity_type"])
        if s is None or o is None:
            return None, None, fail("ENTITY_NOT_FOUND")
        ids = (s["entity_id"], o["entity_id"])
        if open_ := [w["warning_id"] for w in self.warnings.values() if w.get("entity_id") in ids and w.get("kind") in BLOCKING]:
            return s, o, fail("ENTITY_TYPE_REVIEW_PENDING", warning_ids=open_)
        if want["relation_type"] not in self.ontology.pairs:
            return s, o, fail("UNKNOWN_RELATION_TYPE", want["relation_type"])
        if not self.ontology.allows(want["relation_type"], s["entity_type"], o["entity_type"]):
            return s, o, fail("INVALID_RELATION_PAIR")
        return s, o, None

    def add_relation(self, **want: str) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        s, o, error = self._ends(want)
        if error:
            return error
        triple = {"subject": s["entity_id"], "predicate": want["relation_type"], "object": o["entity_id"]}
        if same := next((i for i, r in self.relations.items() if triple.items() <= r.items()), None):
            return ok(relation_id=same, status="existing")
        i = self._new("r")
        self.relations[i] = {"relation_id": i} | triple
        self._changed()
        return ok(relation_id=i, status="created")

    def update_relation(self, relation_id: str, patch: dict) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        if relation_id not in self.relations:
            return fail("RELATION_NOT_FOUND")
        if extra := sorted(set(patch) - set(_REL)):
            return fail("INVALID_PATCH", str(extra))
        now = self._named(self.relations[relation_id])
        want = {k: str(patch.get(k, now[k])) for k in _REL}
        s, o, error = self._ends(want)
        if error:
            return error
        self.relations[relation_id].update(subject=s["entity_id"], predicate=want["relation_type"], object=o["entity_id"])
        self._changed()
        return ok(relation_id=relation_id, status="updated")

    def delete_relation(self, relation_id: str) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        if self.relations.pop(relation_id, None) is None:
            return fail("RELATION_NOT_FOUND")
        self._changed()
        return ok(relation_id=relation_id, status="deleted")

    # reviews -------------------------------------------------------------------------------------
    def confirm_review_warning(self, warning_id: str, reason: str) -> dict:
        if len(reason.strip()) < 8:
            return fail("REVIEW_REASON_TOO_SHORT")
        key = next((k for k, w in self.warnings.items() if w["warning_id"] == warning_id), None)
        if key is None:
            return fail("REVIEW_WARNING_NOT_FOUND")
        w = self.warnings.pop(key)
        return ok(warning_id=warning_id, status="confirmed_current", name=w.get("name"), entity_type=w.get("current_entity_type") or w.get("entity_type"))

    def apply_reviews(self, ids: list[str], reviews: dict[str, dict]) -> dict:
        """Warnings from reviews by name, for entities that are still there."""
        rows = []
        for e in (self.entities[i] for i in ids if i in self.entities):
            key, r = f"entity_type:{e['entity_id']}", reviews.get(e["name"])
            base = {"entity_id": e["entity_id"], "name": e["name"], "current_entity_type": e["entity_type"]}
            if r is None:
                self.warn(key, base | {"kind": "entity_type_review_missing"})
                continue
            fits = r["should_extract"] and r["recommended_entity_type"] == e["entity_type"]
            w = None
            if fits:
                self.warnings.pop(key, None)
            else:
                kind = "entity_type" if r["should_extract"] else "entity_not_extractable"
                w = self.warn(key, base | {"kind": kind, "recommended_entity_type": r["recommended_entity_type"], "confidence": r["confidence"], "reason": r["reason"]})
            rows.append(base | r | {"consistent": fits, "warning_id": w["warning_id"] if w else None})
        off = [r["name"] for r in rows if not r["should_extract"]]
        return ok(reviews=rows, reviewed_count=len(rows), inconsistent_count=sum(not r["consistent"] for r in rows), not_extractable_count=len(off), not_extractable_names=off)

    # lifecycle -----------------------------------------------------------------------------------
    def issues(self) -> list[dict]:
        out: list[dict] = []
        add = lambda code, item: out.append({"code": code, "item_id": item})
        seen: set = set()
        for i, e in self.entities.items():
            if not e["name"].strip():
                add("EMPTY_NAME", i)
            if e["entity_type"] not in self.ontology.types:
                add("UNKNOWN_ENTITY_TYPE", i)
            if self._lacking(e["name"], e["entity_type"]):
                add("INVALID_ENTITY_EVIDENCE", i)
            key = (e["name"], e["entity_type"])
            if key in seen:
                add("DUPLICATE_ENTITY", i)
            seen.add(key)
        for i, r in self.relations.items():
            s, o = self.entities.get(r["subject"]), self.entities.get(r["object"])
            if s is None or o is None:
                add("MISSING_RELATION_ENTITY", i)
                continue
            if r["predicate"] not in self.ontology.pairs:
                add("UNKNOWN_RELATION_TYPE", i)
            elif not self.ontology.allows(r["predicate"], s["entity_type"], o["entity_type"]):
                add("RELATION_TYPE_MISMATCH", i)
            key = (r["subject"], r["predicate"], r["object"])
            if key in seen:
                add("DUPLICATE_RELATION", i)
            seen.add(key)
        return out

    def validate_chunk(self) -> dict:
        issues = self.issues()
        if not issues:
            self.validated = self.revision
        return ok(valid=not issues, errors=issues, review_warnings=list(self.warnings.values()))

    def confirm_empty_chunk(self, reason: str) -> dict:
        if self.committed:
            return fail("CHUNK_COMMITTED")
        if self.entities or self.relations:
            return fail("CHUNK_NOT_EMPTY")
        if len(reason.strip()) < 4:
            return fail("EMPTY_REASON_TOO_SHORT")
        self.emptied, self.empty_reason = self.revision, reason.strip()
        return ok(status="empty_confirmed", reason=self.empty_reason)

    def submit_chunk(self) -> dict:
        if self.committed:
            return ok(status="already_committed")
        if self.warnings:
            return fail("REVIEW_WARNINGS_PENDING", warnings=list(self.warnings.values()))
        if self.validated != self.revision:
            return fail("CHUNK_NOT_VALIDATED")
        if not self.entities and self.emptied != self.revision:
            return fail("EMPTY_CHUNK_NOT_CONFIRMED")
        if issues := self.issues():
            return fail("VALIDATION_FAILED", errors=issues)
        self.committed = True
        return ok(status="committed")

    def call(self, tool: str, arguments: Any) -> dict:
        """Check the arguments, then run the tool."""
        return wrong_arguments(tool, arguments) or getattr(self, tool)(**arguments)


REPLAY_SCHEMA = "source_id string, ord int, tool string, ok boolean, code string, result string, state string"
_REPLAYED = pa.schema({"source_id": pa.string(), "ord": pa.int32(), "tool": pa.string(), "ok": pa.bool_(), "code": pa.string(), "result": pa.string(), "state": pa.string()})
_TRACE = 2  # the last columns: a call's answer and the state after it
_AT_ONCE = 256  # chunks; with every state a chunk's text is repeated for each of its calls


def replay(calls: DataFrame, ontology: Ontology, trace: bool = True) -> DataFrame:
    """Recorded calls (source_id, text, ord, tool, arguments JSON) to one row per call with the state after it.

    The text is that of a chunk's first call. See ``replay_chunks``.
    """
    chunks = calls.groupBy("source_id").agg(F.min_by("text", "ord").alias("text"), F.sort_array(F.collect_list(F.struct("ord", "tool", "arguments"))).alias("calls"))
    return replay_chunks(chunks, ontology, trace)


def replay_chunks(chunks: DataFrame, ontology: Ontology, trace: bool = True) -> DataFrame:
    """Chunks (source_id, text, calls: array of ord, tool, arguments JSON in order) to one row per call.

    One row per chunk, so its text moves once; a chunk's calls are few. Chunks are independent, so a hot file costs
    nothing. Without ``trace`` neither answers nor states are written out, which repeat the text for every call.
    """
    schema = pa.schema(list(_REPLAYED)[: None if trace else -_TRACE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, _AT_ONCE):
                rows = _replayed(b.slice(at, _AT_ONCE), ontology, trace)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema)], schema=schema)

    return chunks.select("source_id", "text", "calls").mapInArrow(run, ", ".join(REPLAY_SCHEMA.split(", ")[: len(schema)]))


def _replayed(chunks: pa.RecordBatch, ontology: Ontology, trace: bool) -> list[tuple]:
    sids, texts, calls = chunks.columns
    each = zip(*(c.to_pylist() for c in calls.flatten().flatten()))  # the calls of all chunks, field by field
    rows = []
    for sid, text, many in zip(sids.to_pylist(), texts.to_pylist(), calls.value_lengths().to_pylist()):
        d = Draft(sid, text or "", ontology)
        for _ in range(many or 0):
            n, tool, args = next(each)
            r = d.call(tool, json.loads(args or "{}"))
            row = (sid, n, tool, r["ok"], None if r["ok"] else r["error"]["code"])
            rows.append((*row, json.dumps(r, ensure_ascii=False), d.to_json()) if trace else row)
    return rows
