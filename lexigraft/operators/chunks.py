"""Document text to content-addressed, overlapping windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigraft.functions.text import collapse_ws, is_blank


def window_count(length: Column, size: int, overlap: int) -> Column:
    """Number of windows of a text of that length: one up to ``size``, then one per step begun."""
    return F.when(length <= size, F.lit(1)).otherwise(F.ceil((length - overlap) / F.lit(float(size - overlap)))).cast("int")


def text_windows(text: Column, size: int = 1000, overlap: int = 100) -> Column:
    """Array of windows of ``size`` characters, each sharing ``overlap`` with the one before.

    The positions have a closed form, so no state is carried and the text is cut in one expression.
    An empty text has one empty window; null gives null.
    """
    if size < 1:
        raise ValueError("size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("overlap must lie in [0, size)")
    n = window_count(F.length(text), size, overlap)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, (i * (size - overlap) + 1).cast("int"), F.lit(size)))


def source_key(namespace: Column, path: Column, index: Column) -> Column:
    """``namespace:path#chunk_i``."""
    return F.concat(namespace, F.lit(":"), path, F.lit("#chunk_"), index.cast("string"))


def content_id(identity: Column, name: Column, text: Column) -> Column:
    """Hex sha256 of identity, NUL and text; an empty or null identity falls back to the name."""
    who = F.when(F.coalesce(identity, F.lit("")) == "", name).otherwise(identity)
    return F.sha2(F.concat(who, F.lit("\0"), text), 256)


def chunk_documents(docs: DataFrame, key: str, text: str, namespace: str, path: Column, size: int = 1000, overlap: int = 100) -> DataFrame:
    """(key, chunk_index, source_id, text): normalised, cut, blank windows dropped but counted."""
    norm = docs.select(F.col(key), path.alias("__p"), collapse_ws(F.col(text)).alias("__t")).where(F.col("__t").isNotNull())
    w = norm.select(key, "__p", F.posexplode(text_windows(F.col("__t"), size, overlap)).alias("chunk_index", "text"))
    w = w.where(~is_blank(F.col("text")))
    sk = source_key(F.lit(namespace), F.col("__p"), F.col("chunk_index"))
    return w.select(key, "chunk_index", content_id(sk, F.col("__p"), F.col("text")).alias("source_id"), "text")
