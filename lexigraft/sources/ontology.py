"""Ontology files and cache namespaces."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Ontology:
    """Entity types with guidance and the pairs of types each relation may join.

    A few hundred rows at most: it is configuration, read on the driver and joined as small tables.
    """

    types: tuple[str, ...]
    guidance: dict[str, dict] = field(default_factory=dict)
    pairs: dict[str, frozenset[tuple[str, str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, config: dict) -> "Ontology":
        known = {"description": "", "positive_examples": [], "negative_examples": []}
        guidance = {}
        for name, given in config["entity_types"].items():
            if extra := sorted(set(given) - set(known)):
                raise ValueError(f"entity type {name!r} has unknown fields {extra}")
            guidance[str(name)] = {k: given.get(k, v) for k, v in known.items()}
        if not guidance:
            raise ValueError("no entity types")
        pairs = {}
        for name, given in config["relation_types"].items():
            pairs[name] = frozenset((str(p[0]), str(p[1])) for p in given["allowed_pairs"])
            if unknown := sorted({t for p in pairs[name] for t in p} - set(guidance)):
                raise ValueError(f"relation {name!r} uses unknown types {unknown}")
        return cls(tuple(guidance), guidance, pairs)

    @classmethod
    def read(cls, path: str) -> "Ontology":
        return cls.of(json.loads(Path(path).read_text(encoding="utf-8")))

    def allows(self, relation: str, head: str, tail: str) -> bool:
        return (head, tail) in self.pairs.get(relation, ())

    def types_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.types)), "ord int, entity_type string")

    def guidance_df(self, spark: SparkSession) -> DataFrame:
        rows = [(t, g["description"], list(g["positive_examples"]), list(g["negative_examples"])) for t, g in self.guidance.items()]
        return spark.createDataFrame(rows, "entity_type string, description string, positive array<string>, negative array<string>")

    def rules_df(self, spark: SparkSession) -> DataFrame:
        rows = sorted((r, h, t) for r, ps in self.pairs.items() for h, t in ps)
        return spark.createDataFrame(rows, "relation_type string, head_type string, tail_type string")


def cache_namespace(path: str | None, model: str) -> str:
    """The namespace configured for a model; ``model:<name>`` where there is no file or entry."""
    if not path or not Path(path).exists():
        return f"model:{model}"
    return json.loads(Path(path).read_text(encoding="utf-8"))["model_namespaces"].get(model) or f"model:{model}"
