"""Row functions over Arrow batches with typed results: batches without a row are no special case."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema


def record_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def map_rows(df: DataFrame, make: Callable[..., Iterable[tuple]], schema: pa.Schema) -> DataFrame:
    """``make(*columns)`` (Python lists, batch by batch) as rows of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield record_batch(make(*(c.to_pylist() for c in b.columns)), schema)

    return df.mapInArrow(run, from_arrow_schema(schema))
