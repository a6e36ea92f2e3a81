"""All queries of the core library by name."""

from __future__ import annotations

from lexigraft.plans import domain, dumps, graph, pages, readers, text

_MODULES = [domain, graph, text, pages, dumps, readers]
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
FLAGSHIP = graph.flagship
