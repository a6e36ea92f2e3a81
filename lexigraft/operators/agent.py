"""Extraction of a graph from chunks by a chat model, with independent review.

The model is a backend: anything with ``complete(messages) -> str``. ``Replay`` answers from recorded
turns, ``Lexicon`` is a deterministic offline extractor, ``HttpChat`` speaks to a chat endpoint. One
client is made per partition. Results carry everything a commit needs and should be written right
after this stage, so that a lost executor never asks a model twice for stored chunks.
"""

from __future__ import annotations

import json
import os
import re
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from lexigraft.operators.drafts import Draft
from lexigraft.operators.protocol import ACTION, THOUGHT, TOOLS, parse_actions, parse_reviews
from lexigraft.sources.ontology import Ontology


class ChatClient(Protocol):
    def complete(self, messages: list[dict[str, str]]) -> str: ...


class Replay:
    """Answers from a list of turns; an exhausted list answers with an empty text."""

    def __init__(self, turns: list[str]):
        self.turns = iter(turns)

    def complete(self, messages: list[dict[str, str]]) -> str:
        return next(self.turns, "")


class Lexicon:
    """Offline extraction: every listed name found in the chunk becomes an entity, then submit."""

    def __init__(self, names: dict[str, str]):
        self.names = names

    def complete(self, messages: list[dict[str, str]]) -> str:
        text = messages[1]["content"]
        found = [(n, t) for n, t in self.names.items() if n in text]
        calls = [("add_entity", {"name": n, "entity_type": t}) for n, t in found] or [("confirm_empty_chunk", {"reason": "no listed name"})]
        calls += [("validate_chunk", {}), ("submit_chunk", {})]
        return f"{THOUGHT}listed names\n{ACTION}\n" + "\n".join(json.dumps({"tool": t, "arguments": a}, ensure_ascii=False) for t, a in calls)


class HttpChat:
    """A chat-completions endpoint. ``stream`` reads tokens as they come."""

    def __init__(self, url: str, model: str, key: str = "", temperature: float = 0.6, timeout: float = 300, stream: bool = False):
        self.url, self.model, self.key, self.temperature, self.timeout, self.stream = url, model, key, temperature, timeout, stream

    @classmethod
    def from_env(cls, prefix: str = "LLM") -> "HttpChat":
        return cls(os.environ[f"{prefix}_API_BASE"].rstrip("/") + "/chat/completions", os.environ[f"{prefix}_MODEL"], os.environ.get(f"{prefix}_API_KEY", ""))

    def complete(self, messages: list[dict[str, str]]) -> str:
        body = json.dumps({"model": self.model, "messages": messages, "temperature": self.temperature, "stream": self.stream}).encode()
        req = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urllib.request.urlopen(req, timeout=self.timeout) as r:
            if not self.stream:
                return json.load(r)["choices"][0]["message"]["content"] or ""
            parts = [json.loads(x[6:])["choices"][0]["delta"].get("content") or "" for x in r if x.startswith(b"data: {")]
            return "".join(parts)


def system_prompt(ontology: Ontology) -> str:
    """What the model is told once: output form, tools, types and pairs."""
    tools = "\n".join(f"- {n}({', '.join(a)})" for n, (a, _) in TOOLS.items() if n != "get_workspace_summary")
    types = "\n".join(f"- {t}: {g['description']}" for t, g in ontology.guidance.items())
    pairs = "\n".join(f"- {r}: " + ", ".join(f"{h}->{t}" for h, t in sorted(p)) for r, p in ontology.pairs.items())
    return f"Answer with {THOUGHT} and a short reason, then {ACTION} and one JSON object per line with tool and arguments.\nTools:\n{tools}\nEntity types:\n{types}\nRelations:\n{pairs}"


def snapshot(d: Draft) -> str:
    """The draft as the model sees it after each turn; warnings without empty fields."""
    small = [{k: v for k, v in w.items() if v is not None} for w in d.list_review_warnings()["warnings"]]
    return json.dumps({"entities": list(d.entities.values()), "relations": d.list_relations()["relations"], "review_warnings": small}, ensure_ascii=False)


def compact(steps: list[tuple[str, dict]]) -> list[dict]:
    """Neighbouring results of one tool as one entry; ``ok`` only if all are."""
    out: list[dict] = []
    for tool, result in steps:
        rest = {k: v for k, v in result.items() if k != "ok"}
        if out and out[-1]["tool"] == tool:
            out[-1]["ok"] &= result["ok"]
            out[-1]["results"].append(rest)
        else:
            out.append({"tool": tool, "ok": result["ok"], "results": [rest]})
    return out


class Reviewer:
    """Independent type review: the current type is never shown, equal (name, context) are asked once.

    Batches of ``size``; rows that are missing are asked again, at most ``attempts`` times in all.
    """

    def __init__(self, client: ChatClient, ontology: Ontology, cache: dict | None = None, size: int = 5, attempts: int = 3):
        self.client, self.ontology, self.cache, self.size, self.attempts = client, ontology, {} if cache is None else cache, size, attempts

    def review(self, requests: list[tuple[str, str]]) -> tuple[dict[tuple[str, str], dict], list[dict]]:
        todo = [r for r in dict.fromkeys(requests) if r not in self.cache]
        errors: list[dict] = []
        for at in range(0, len(todo), self.size):
            left = todo[at : at + self.size]
            for _ in range(self.attempts):
                ask = [{"name": n, "context": c} for n, c in left]
                raw = self.client.complete([{"role": "system", "content": "Review the type of each entity."}, {"role": "user", "content": json.dumps(ask, ensure_ascii=False)}])
                got, wrong = parse_reviews(raw, [n for n, _ in left], self.ontology.types)
                self.cache.update({(n, c): got[n] for n, c in left if n in got})
                left = [r for r in left if r not in self.cache]
                if not left:
                    break
            else:
                errors += wrong
        return {r: self.cache[r] for r in requests if r in self.cache}, errors


def context_of(text: str, name: str, radius: int = 160) -> str:
    """Pieces of text around the first hits of a name; see ``review.local_context`` for the column form."""
    parts = [m for m in name.split("|") if m]
    grouped = "|" in name and name not in text and len(parts) > 1
    hits = []
    for p in parts if grouped else [name]:
        hits += [(m.start(), m.end()) for n, m in zip(range(1 if grouped else 3), re.finditer(re.escape(p), text))]
    return "\n…\n".join(dict.fromkeys(text[max(0, a - radius) : b + radius] for a, b in sorted(hits)))


def run_chunk(d: Draft, client: ChatClient, reviewer: Reviewer | None = None, max_steps: int = 80) -> dict[str, Any]:
    """One chunk to its end: committed, already_committed or max_steps_exceeded."""
    if d.committed:
        return {"status": "already_committed", "steps": 0, "tool_calls": 0, "parse_errors": 0}
    base = [{"role": "system", "content": system_prompt(d.ontology)}, {"role": "user", "content": d.text}]
    last: list[dict[str, str]] = []
    calls = bad = 0
    fresh: list[str] = []
    for step in range(1, max_steps + 1):
        raw = client.complete(base + last)
        actions, errors = parse_actions(raw)
        bad += len(errors)
        seen: list[tuple[str, dict]] = [("parse", {"ok": False, "error": {"code": "INVALID_ACTION_LINE", "message": e}}) for e in errors]
        failed = bool(errors)
        for tool, args in actions:
            if reviewer and fresh and tool in ("add_relation", "update_relation", "submit_chunk"):
                seen.append(("review_entity_types", _review(d, reviewer, fresh)))
                fresh = []
            if tool == "submit_chunk" and failed:
                result = {"ok": False, "error": {"code": "BATCH_HAS_FAILURES", "message": "an action before failed"}}
            else:
                result = d.call(tool, args)
            calls += 1
            seen.append((tool, result))
            failed |= not result["ok"] or tool == "validate_chunk" and not result["valid"]
            if result["ok"] and (result.get("status") == "created" and tool == "add_entity" or result.get("identity_changed")):
                fresh.append(result["entity_id"])
            if tool == "submit_chunk" and result["ok"]:
                return {"status": result["status"], "steps": step, "tool_calls": calls, "parse_errors": bad}
        if reviewer and fresh:
            seen.append(("review_entity_types", _review(d, reviewer, fresh)))
            fresh = []
        last = [{"role": "assistant", "content": raw}, {"role": "user", "content": json.dumps(compact(seen), ensure_ascii=False) + "\n" + snapshot(d)}]
    return {"status": "max_steps_exceeded", "steps": max_steps, "tool_calls": calls, "parse_errors": bad}


def _review(d: Draft, reviewer: Reviewer, ids: list[str]) -> dict:
    live = [i for i in ids if i in d.entities]
    names = {i: d.entities[i]["name"] for i in live}
    reviews, errors = reviewer.review([(n, context_of(d.text, n)) for n in names.values()])
    out = d.apply_reviews(live, {n: r for (n, _), r in reviews.items()})
    return out | ({"ok": False, "error": {"code": "PARTIAL_ENTITY_REVIEW", "message": "", "review_errors": errors}} if errors else {})


RESULT_SCHEMA = "source_id string, status string, steps int, tool_calls int, parse_errors int, entities array<struct<name:string,entity_type:string>>, relations array<struct<subject:int,relation_type:string,object:int>>, error string"


def extract(chunks: DataFrame, ontology: Ontology, client: Callable[[], ChatClient], reviewer: Callable[[], Reviewer] | None = None, max_steps: int = 80) -> DataFrame:
    """Chunks (source_id, text) to results; a chunk that raises becomes a ``failed`` row.

    ``client`` and ``reviewer`` are called once per partition. Join away stored chunks first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, r = client(), reviewer() if reviewer else None
        for pdf in batches:
            rows = []
            for sid, text in zip(pdf["source_id"], pdf["text"]):
                d = Draft(sid, text or "", ontology)
                try:
                    out, error = run_chunk(d, c, r, max_steps), None
                except Exception as e:  # noqa: BLE001  one chunk never ends the run
                    out, error = {"status": "failed", "steps": 0, "tool_calls": 0, "parse_errors": 0}, f"{type(e).__name__}: {e}"
                done = out["status"] == "committed"
                at = {i: n for n, i in enumerate(d.entities)}
                ents = [{"name": e["name"], "entity_type": e["entity_type"]} for e in d.entities.values()] if done else []
                rels = [{"subject": at[x["subject"]], "relation_type": x["predicate"], "object": at[x["object"]]} for x in d.relations.values()] if done else []
                rows.append((sid, out["status"], out["steps"], out["tool_calls"], out["parse_errors"], ents, rels, error))
            yield pd.DataFrame(rows, columns=["source_id", "status", "steps", "tool_calls", "parse_errors", "entities", "relations", "error"])

    return chunks.select("source_id", "text").mapInPandas(run, RESULT_SCHEMA)
