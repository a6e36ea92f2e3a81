import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import same  # noqa: E402

from lexigraft.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    same(spark, sf, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


def test_columns(spark, sf):
    want = {
        "p2_found": {"source_id": "string"}, "p4_found": {"id_a": "bigint", "id_b": "bigint"}, "p5_found": {"id": "bigint", "field": "string", "canon_id": "bigint"},
        "p6_found": {"source_id": "string", "noise": "string"}, "p7_ids": {"doc_id": "bigint", "ids": "array<int>"}, "p8_found": {"doc_id": "bigint", "item_id": "bigint"}, "p9_found": {"doc_id": "bigint"},
    }
    for name, cols in want.items():
        assert dict(queries.QUERIES[name](spark, sf).dtypes) == cols
