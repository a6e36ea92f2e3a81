"""Nested records to related flat tables by Dewey labels.

Every object below an array column is a node. Its label joins the 0-based positions of the arrays
passed from the column down to it (``0.3.0``), its schema path the field names
(``ExternalReferenceList.ExternalReference.DisorderMappingRelation``). A parent's label is the
child's label less its last part, so no join is needed to link tables, and nodes of one schema
path form one table.

Defined results
* a null, absent or empty array has no nodes; a null object is no node but keeps its position;
* declared counts are data, they decide nothing;
* arrays of arrays pass one position each; scalar arrays stay columns of their node;
* rows with a null key keep null as key; repeated rows give equal nodes, which ``distinct`` merges;
* columns beside ``key`` and the roots are never touched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _objects(t: T.DataType) -> T.StructType | None:
    """The struct type of an array of objects, else None."""
    return t.elementType if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType) else None


def schema_paths(schema: T.StructType, roots: list[str]) -> dict[str, T.StructType]:
    """Schema path -> type of every array of objects reachable from the roots."""
    out: dict[str, T.StructType] = {}

    def walk(path: str, t: T.DataType) -> None:
        if (s := _objects(t)) is not None:
            out[path] = s
            for f in s.fields:
                walk(f"{path}.{f.name}", f.dataType)

    for r in roots:
        walk(r, schema[r].dataType)
    return out


def prune_leaves(schema: T.StructType, key: str, roots: list[str]) -> T.StructType:
    """The smallest scan schema that still tells positions and null objects.

    Each object keeps its arrays of objects, or one scalar if it has none; long text leaves are
    never read. Pass it to ``spark.read.schema``.
    """

    def cut(t: T.DataType) -> T.DataType:
        s = _objects(t)
        if s is None:
            return t
        inner = [T.StructField(f.name, cut(f.dataType)) for f in s.fields if _objects(f.dataType) is not None]
        if not inner:
            scalars = [f for f in s.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
            inner = [(scalars or s.fields)[0]]
        return T.ArrayType(T.StructType(inner))

    return T.StructType([schema[key]] + [T.StructField(r, cut(schema[r].dataType)) for r in roots])


_LABEL = "array<struct<schema_path:string,dewey:string,payload:string>>"


def _nodes(arr: Column, t: T.StructType, path: str, prefix: Column | None, keep: set[str] | None, payload: bool) -> Column:
    empty = F.array().cast(_LABEL)

    def one(x: Column, i: Column) -> Column:
        label = i.cast("string") if prefix is None else F.concat(prefix, F.lit("."), i.cast("string"))
        body = F.lit(None).cast("string")
        if payload:
            flat = [x[f.name].alias(f.name) for f in t.fields if _objects(f.dataType) is None]
            body = F.to_json(F.struct(*flat)) if flat else F.lit("{}")
        parts = []
        if keep is None or path in keep:
            parts.append(F.array(F.struct(F.lit(path).alias("schema_path"), label.alias("dewey"), body.alias("payload"))))
        for f in t.fields:
            sub, below = _objects(f.dataType), f"{path}.{f.name}"
            if sub is not None and (keep is None or any(k == below or k.startswith(below + ".") for k in keep)):
                parts.append(_nodes(x[f.name], sub, below, label, keep, payload))
        return F.when(x.isNotNull(), F.concat(*parts) if parts else empty).otherwise(empty)

    return F.coalesce(F.flatten(F.transform(arr, one)), empty)


def dewey_nodes(df: DataFrame, key: str, roots: list[str], keep: set[str] | None = None, payload: bool = False) -> DataFrame:
    """(key, schema_path, dewey, payload) of every node below the root columns, in one pass.

    ``keep`` restricts schema paths; ``payload`` adds the node's own fields as JSON. There is no
    shuffle: a row's nodes are made where the row is read.
    """
    parts = [
        _nodes(F.col(f"`{r}`"), _objects(df.schema[r].dataType), r, None, keep, payload)
        for r in roots
        if _objects(df.schema[r].dataType) is not None and (keep is None or any(k == r or k.startswith(r + ".") for k in keep))
    ]
    if not parts:
        raise ValueError("no root column is an array of objects")
    n = df.select(F.col(f"`{key}`").alias("__key"), F.explode(F.concat(*parts)).alias("n"))
    return n.select(F.col("__key").alias(key), "n.schema_path", "n.dewey", "n.payload")


def parent_label(dewey: Column) -> Column:
    """The label less its last part; null for a node directly below a root column."""
    return F.when(dewey.contains("."), F.regexp_replace(dewey, r"\.[0-9]+$", ""))


def flat_table(df: DataFrame, key: str, path: str) -> DataFrame:
    """The table of one schema path: key, node, parent, then the object's own fields.

    ``node`` is ``<root>.<dewey>``, ``parent`` the same of the enclosing object, null for objects
    directly below the root column. Fields that clash with those three get the suffix ``_value``.
    """
    root = path.split(".")[0]
    t = schema_paths(df.schema, [root])[path]
    own = [f for f in t.fields if _objects(f.dataType) is None]
    n = dewey_nodes(df, key, [root], keep={path}, payload=bool(own))
    at = F.lit(root + ".")
    cols = [F.col(f"`{key}`"), F.concat(at, "dewey").alias("node"), F.concat(at, parent_label(F.col("dewey"))).alias("parent")]
    if own:
        n = n.withColumn("__o", F.from_json("payload", T.StructType(own)))
        taken = {key.lower(), "node", "parent"}
        cols += [F.col("__o")[f.name].alias(f.name + ("_value" if f.name.lower() in taken else "")) for f in own]
    return n.select(*cols).distinct()


def flat_tables(df: DataFrame, key: str, roots: list[str]) -> dict[str, DataFrame]:
    """Schema path -> its flat table, for every array of objects below the roots."""
    return {path: flat_table(df, key, path) for path in schema_paths(df.schema, roots)}
