"""Projection and schema shaping: select/drop/rename fields (nested paths too),
split a frame by columns, apply a frame schema, filter by row function.

Everything except the Python row predicate is a plain projection/filter, so
Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.casting import safe_cast


def _tree(paths: Sequence[str]) -> dict:
    root: dict = {}
    for p in paths:
        node = root
        parts = p.split(".")
        for i, part in enumerate(parts):
            if i == len(parts) - 1:
                node[part] = True
            else:
                nxt = node.get(part)
                if nxt is True:
                    break
                node = node.setdefault(part, {})
    return root


def _pick(col: Column, dtype: T.DataType, sub: dict | bool) -> Column:
    if sub is True or not isinstance(dtype, T.StructType):
        return col
    fields = []
    for f in dtype.fields:
        if f.name in sub:
            fields.append(_pick(col.getField(f.name), f.dataType, sub[f.name]).alias(f.name))
    return F.struct(*fields)


def select_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Keep the listed fields (top-level or nested ``a.b``) in schema order;
    unknown paths are ignored. A nested path keeps its struct with only the
    listed sub-fields."""
    tree = _tree(paths)
    out = []
    for f in df.schema.fields:
        if f.name in tree:
            out.append(_pick(F.col(f"`{f.name}`"), f.dataType, tree[f.name]).alias(f.name))
    return df.select(out)


def drop_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Drop top-level columns and nested struct fields (``Column.dropFields``;
    a plain ``drop('a.b')`` would silently do nothing)."""
    top = [p for p in paths if "." not in p or p in df.columns]
    out = df.drop(*top)
    for p in paths:
        if p in top:
            continue
        head, rest = p.split(".", 1)
        if head in out.columns:
            out = out.withColumn(head, F.col(f"`{head}`").dropFields(rest))
    return out


def rename_field(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a top-level column or a nested field (``a.b`` → ``a.c`` or ``c``)."""
    if old in df.columns or "." not in old:
        return df.withColumnRenamed(old, new)
    head, rest = old.split(".", 1)
    new_leaf = new.split(".")[-1]
    parent = rest.rsplit(".", 1)[0] if "." in rest else None
    target = f"{parent}.{new_leaf}" if parent else new_leaf
    c = F.col(f"`{head}`")
    return df.withColumn(head, c.withField(target, F.col(old)).dropFields(rest))


def split_fields(df: DataFrame, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Two frames: the chosen fields, and the rest."""
    return select_fields(df, paths), drop_fields(df, paths)


def with_frame_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Conform a frame to a schema: listed columns in order, cast without
    failure (bad → NULL), missing columns as NULL, others dropped."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # noqa: SLF001 (public DDL parsing)
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(safe_cast(F.col(f"`{f.name}`"), f.dataType.simpleString()).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(cols)


def filter_rows(df: DataFrame,
                predicate: Column | str | Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Filter by a Column, a SQL text, or a Python predicate.

    Column/SQL predicates stay JVM-side and reach the scan as pushed filters.
    A Python predicate receives an Arrow batch as a pandas DataFrame (integers
    and booleans in nullable types, so a NULL alters no other value) and
    returns a boolean Series; NULL → dropped. The kept rows are cut from the
    Arrow batch itself and never pass through pandas.
    """
    if isinstance(predicate, Column):
        return df.filter(predicate)
    if isinstance(predicate, str):
        return df.filter(F.expr(predicate))

    def run(batches):
        for batch in batches:
            pdf = pa.Table.from_batches([batch]).to_pandas(types_mapper=_NULLABLE.get)
            mask = pd.Series(predicate(pdf), index=pdf.index).fillna(False).astype(bool)
            yield batch.filter(pa.array(mask.to_numpy()))

    return df.mapInArrow(run, df.schema)


_NULLABLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(),
             pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()}


def schema_has_field(schema: T.StructType, path: str) -> bool:
    return schema_get_field(schema, path) is not None


def schema_get_field(schema: T.StructType, path: str) -> T.StructField | None:
    node: T.DataType = schema
    found = None
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            return None
        found = node[part]
        node = found.dataType
    return found


def schema_add_field(schema: T.StructType, name: str, dtype: T.DataType | str,
                     nullable: bool = True) -> T.StructType:
    """New schema with one more field (the input schema is not changed)."""
    return T.StructType(list(schema.fields)).add(name, dtype, nullable)
