"""Flatten nested records into one column per leaf."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_paths(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema.fields:
        here = path + (f.name,)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from leaf_paths(f.dataType, here)
        else:
            yield here


def path_col(path: tuple[str, ...]) -> Column:
    c = F.col(f"`{path[0]}`")
    for part in path[1:]:
        c = c.getField(part)
    return c


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Select every leaf as ``a<sep>b<sep>c``; a NULL struct gives NULL leaves.

    Arrays stay values (like ``json_normalize``). Narrow: a projection only.
    """
    return df.select(*[path_col(p).alias(sep.join(p)) for p in leaf_paths(df.schema)])


# ---- records whose keys are not known beforehand ------------------------------------
def observed_schema(docs: DataFrame, column: str = "doc") -> T.StructType:
    """The tree of keys that the VARIANT records have, from one aggregation (one row comes back).

    A key is there if any record has it, on whatever page; values of unlike types
    make it VARIANT; a key that is always null is VOID. Records that are no objects
    have no keys (where there are any, a second pass leaves them out).
    """
    for rows in (docs, docs.filter(F.schema_of_variant(column).startswith("OBJECT<"))):
        text = rows.agg(F.schema_of_variant_agg(column)).first()[0] or ""
        if text != "VARIANT":
            break
    return tree_of(text)


def tree_of(text: str) -> T.StructType:
    """The schema that ``schema_of_variant`` writes, as a type; other than objects have no keys."""
    struct = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    found = T.DataType.fromDDL(struct) if struct.startswith("STRUCT<") and struct != "STRUCT<>" else T.StructType()
    return found if isinstance(found, T.StructType) else T.StructType()


def merged_schema(one: T.DataType, other: T.DataType) -> T.DataType:
    """The tree of two runs: keys of either; an always-null key takes the other's type, unlike types become VARIANT."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if not (isinstance(one, T.StructType) and isinstance(other, T.StructType)):
        return T.VariantType()
    fields = {f.name: f.dataType for f in one.fields}
    for f in other.fields:
        fields[f.name] = merged_schema(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _at(doc: Column, path: tuple[str, ...], kind: str) -> Column:
    """The value at a path of keys, whatever they contain."""
    for k, key in enumerate(path):
        last = k == len(path) - 1
        quote = next((q for q in "'\"" if key and q not in key), None)
        if quote:
            doc = F.try_variant_get(doc, f"$[{quote}{key}{quote}]", kind if last else "variant")
        else:  # no path can name it
            doc = F.try_variant_get(doc, "$", "map<string,variant>").getItem(key)
            doc = F.try_variant_get(doc, "$", kind) if last else doc
    return doc


def flatten_variant(docs: DataFrame, schema: T.StructType, sep: str = ".", column: str = "doc", keep: tuple[str, ...] = (), json: bool = False) -> DataFrame:
    """``keep`` columns and one column a leaf of the observed tree (``a<sep>b``), absent and null keys as NULL.

    Arrays and keys of unlike types stay values (VARIANT; as JSON text with
    ``json``). Two leaves of one name give one column: the first that is not NULL.
    Narrow: a projection only.
    """
    cols: dict[str, list[Column]] = {}
    for path, kind in _typed_leaves(schema):
        if isinstance(kind, (T.VariantType, T.ArrayType, T.StructType)):
            value = _at(F.col(column), path, "variant")
            value = F.when(~F.is_variant_null(value), value)
            value = F.to_json(value) if json else value
        else:
            value = _at(F.col(column), path, "string" if isinstance(kind, T.NullType) else kind.simpleString())
        cols.setdefault(sep.join(path), []).append(value)
    return docs.select(*keep, *[(F.coalesce(*v) if len(v) > 1 else v[0]).alias(name) for name, v in cols.items()])


def _typed_leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _typed_leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType
