"""Model output: JSON lines, tool actions, tool arguments, review rows.

Parsers are plain Python (model output is small and irregular) and run behind table functions, so a
column of outputs becomes rows of items and errors.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import functions as F

THOUGHT, ACTION = "✿THOUGHT✿", "✿ACTION✿"

S, I, O = {"type": "string"}, {"type": "integer"}, {"type": "object"}
_ENDS = ("subject_entity_name", "subject_entity_type", "relation_type", "object_entity_name", "object_entity_type")
#: tool -> (arguments, how many of them are required, in order)
TOOLS: dict[str, tuple[dict[str, dict], tuple[str, ...]]] = {
    "get_chunk_context": ({}, ()),
    "get_workspace_summary": ({}, ()),
    "list_entities": ({"entity_id": S}, ()),
    "add_entity": ({"name": S, "entity_type": S}, ("name", "entity_type")),
    "update_entity": ({"entity_id": S, "patch": O}, ("entity_id", "patch")),
    "delete_entity": ({"entity_id": S}, ("entity_id",)),
    "list_review_warnings": ({}, ()),
    "confirm_review_warning": ({"warning_id": S, "reason": S}, ("warning_id", "reason")),
    "list_relations": ({"relation_id": S}, ()),
    "add_relation": (dict.fromkeys(_ENDS, S), _ENDS),
    "update_relation": ({"relation_id": S, "patch": O}, ("relation_id", "patch")),
    "delete_relation": ({"relation_id": S}, ("relation_id",)),
    "confirm_empty_chunk": ({"reason": S}, ("reason",)),
    "validate_chunk": ({}, ()),
    "submit_chunk": ({}, ()),
}


def ok(**more: Any) -> dict[str, Any]:
    return {"ok": True, **more}


def fail(code: str, message: str = "", **more: Any) -> dict[str, Any]:
    return {"ok": False, "error": {"code": code, "message": message, **more}}


def json_lines(raw: str | None, skip_blank: bool = False) -> Iterable[tuple[int, dict | None, str | None, str | None]]:
    """(line, object, code, message) for each line; exactly one of object and code is set."""
    text = (raw or "").strip()
    if not text:
        yield 1, None, "EMPTY_JSONL", "no lines"
        return
    for n, line in enumerate(text.splitlines(), 1):
        if not (line := line.strip()):
            if not skip_blank:
                yield n, None, "EMPTY_JSONL_LINE", "blank line"
            continue
        try:
            value = json.loads(line)
        except json.JSONDecodeError as e:
            yield n, None, "INVALID_JSON", str(e)
            continue
        yield (n, value, None, None) if isinstance(value, dict) else (n, None, "INVALID_JSON_OBJECT", "not an object")


def parse_actions(raw: str | None) -> tuple[list[tuple[str, dict]], list[str]]:
    """(actions, errors) of one turn: one thought first, then one action block of JSON lines."""
    text = (raw or "").strip()
    wrong = [f"{m} must occur once, not {n} times" for m in (THOUGHT, ACTION) if (n := text.count(m)) != 1]
    if wrong:
        return [], wrong
    before, _, body = text.partition(ACTION)
    if not before.startswith(THOUGHT):
        return [], [f"{THOUGHT} must come first, {ACTION} after it"]
    if not before[len(THOUGHT) :].strip():
        wrong.append("the thought is empty")
    if not body.strip():
        wrong.append("there is no action")
    if wrong:
        return [], wrong
    actions, errors = [], []
    later = []
    for n, item, code, message in json_lines(body):
        if item is None:
            errors.append(f"line {n}: {message}")
        elif extra := sorted(set(item) - {"tool", "arguments"}):
            later.append(f"line {n}: unknown fields {extra}")
        elif not isinstance(item.get("tool"), str) or not item["tool"]:
            later.append(f"line {n}: no tool")
        elif not isinstance(item.get("arguments", {}), dict):
            later.append(f"line {n}: arguments are no object")
        else:
            actions.append((item["tool"], item.get("arguments", {})))
    return actions, errors + later


_KINDS = {"string": str, "object": dict, "integer": int, "boolean": bool}


def _wrong_value(key: str, value: Any, spec: dict) -> dict | None:
    kind = spec.get("type")
    if kind in _KINDS and (not isinstance(value, _KINDS[kind]) or kind == "integer" and isinstance(value, bool)):
        return fail("INVALID_ARGUMENT_TYPE", f"{key} is no {kind}")
    if "enum" in spec and value not in spec["enum"]:
        return fail("INVALID_ARGUMENT_VALUE", f"{key} is none of {spec['enum']}")
    if kind == "integer" and not spec.get("minimum", value) <= value <= spec.get("maximum", value):
        return fail("INVALID_ARGUMENT_VALUE", f"{key} is out of range")
    if kind == "object" and "properties" in spec:
        return _wrong_fields(value, spec["properties"], spec.get("required", ()), f"{key}.")
    return None


def _wrong_fields(given: dict, specs: dict[str, dict], required: Iterable[str], prefix: str = "") -> dict | None:
    if missing := sorted(set(required) - set(given)):
        return fail("MISSING_ARGUMENT", f"{prefix}{missing}")
    if unknown := sorted(set(given) - set(specs)):
        return fail("UNKNOWN_ARGUMENT", f"{prefix}{unknown}")
    return next((e for k, v in given.items() if (e := _wrong_value(prefix + k, v, specs[k]))), None)


def wrong_arguments(tool: str, given: Any, tools: dict = TOOLS) -> dict | None:
    """The first thing wrong with a call, or None: tool, object, missing, unknown, then types and values."""
    if tool not in tools:
        return fail("UNKNOWN_TOOL", tool)
    if not isinstance(given, dict):
        return fail("INVALID_ARGUMENTS", "arguments are no object")
    return _wrong_fields(given, *tools[tool])


def tools_for(types: Iterable[str], relations: Iterable[str]) -> dict:
    """The tools with the ontology's names as the only values of their arguments."""
    t, r = {"type": "string", "enum": list(types)}, {"type": "string", "enum": list(relations)}
    known = {"entity_type": t, "subject_entity_type": t, "object_entity_type": t, "relation_type": r}
    return {name: ({k: known.get(k, v) for k, v in args.items()}, need) for name, (args, need) in TOOLS.items()}


REVIEW_FIELDS = {"reason", "name", "should_extract", "recommended_entity_type", "confidence"}


def _wrong_review(r: dict, wanted: set[str], done: set[str], types: Iterable[str]) -> str | None:
    """The code of the first check a review row fails."""
    if set(r) != REVIEW_FIELDS:
        return "INVALID_REVIEW_FIELDS"
    if not isinstance(r["name"], str):
        return "INVALID_REVIEW_NAME_TYPE"
    if r["name"] not in wanted or r["name"] in done:
        return "UNKNOWN_OR_DUPLICATE_REVIEW"
    if not isinstance(r["reason"], str) or not r["reason"].strip():
        return "INVALID_REVIEW_REASON"
    if not isinstance(r["should_extract"], bool):
        return "INVALID_SHOULD_EXTRACT"
    kind = r["recommended_entity_type"]
    if r["should_extract"]:
        if not isinstance(kind, str):
            return "INVALID_RECOMMENDED_TYPE"
        if kind not in types:
            return "UNKNOWN_RECOMMENDED_TYPE"
    elif kind is not None:
        return "UNEXPECTED_RECOMMENDED_TYPE"
    c = r["confidence"]
    if isinstance(c, bool) or not isinstance(c, (int, float)) or not math.isfinite(c) or not 0 <= c <= 1:
        return "INVALID_REVIEW_CONFIDENCE"
    return None


def parse_reviews(raw: str | None, names: list[str], types: Iterable[str]) -> tuple[dict[str, dict], list[dict]]:
    """(reviews by name, errors) of one answer; names without a valid row are errors too."""
    got: dict[str, dict] = {}
    errors: list[dict] = []
    wanted = set(names)
    later = []
    for n, item, code, message in json_lines(raw, skip_blank=True):
        if item is None:
            errors.append({"line": n, "code": "INVALID_REVIEW_ITEM" if code == "INVALID_JSON_OBJECT" else "INVALID_REVIEW_JSON", "message": message})
        elif bad := _wrong_review(item, wanted, set(got), types):
            later.append({"line": n, "code": bad, "message": bad})
        else:
            got[item["name"]] = item | {"reason": item["reason"].strip(), "confidence": round(float(item["confidence"]), 2)}
    lost = [{"code": "MISSING_ENTITY_REVIEW", "name": x, "message": x} for x in dict.fromkeys(names) if x not in got]
    return got, errors + later + lost


class JsonLines:
    """Table function: raw -> (line, payload, code, message)."""

    def eval(self, raw: str):
        for n, item, code, message in json_lines(raw):
            yield n, None if item is None else json.dumps(item, ensure_ascii=False), code, message


class Actions:
    """Table function: raw -> (ord, tool, arguments, error)."""

    def eval(self, raw: str):
        actions, errors = parse_actions(raw)
        for i, (tool, args) in enumerate(actions):
            yield i, tool, json.dumps(args, ensure_ascii=False), (wrong_arguments(tool, args) or {"error": {"code": None}})["error"]["code"]
        for e in errors:
            yield None, None, None, e


class Reviews:
    """Table function: (raw, names, types) -> (name, should_extract, recommended_entity_type, confidence, reason, code)."""

    def eval(self, raw: str, names: list, types: list):
        got, errors = parse_reviews(raw, list(names or []), list(types or []))
        for r in got.values():
            yield r["name"], r["should_extract"], r["recommended_entity_type"], r["confidence"], r["reason"], None
        for e in errors:
            yield e.get("name"), None, None, None, None, e["code"]


def register(spark) -> None:
    """The parsers as SQL table functions ``json_lines``, ``tool_actions`` and ``review_rows``."""
    spark.udtf.register("json_lines", F.udtf(JsonLines, returnType="line int, payload string, code string, message string"))
    spark.udtf.register("tool_actions", F.udtf(Actions, returnType="ord int, tool string, arguments string, error string"))
    spark.udtf.register("review_rows", F.udtf(Reviews, returnType="name string, should_extract boolean, recommended_entity_type string, confidence double, reason string, code string"))
