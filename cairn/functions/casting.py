"""Casts that never fail, and ``apply_mapping``.

Spark 4 runs in ANSI mode, where ``cast('N/A' AS DOUBLE)`` raises; the
reference's casts turn bad values into NULL, so every cast here is a
``try_cast`` (JVM-side, stays in whole-stage codegen).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names used by mappings, as written in the reference.
TYPE_ALIASES = {
    "string": "string", "double": "double", "float": "float", "date": "date",
    "timestamp": "timestamp", "bigint": "bigint", "long": "bigint", "int": "int",
    "integer": "int", "smallint": "smallint", "short": "smallint", "tinyint": "tinyint",
    "byte": "tinyint", "boolean": "boolean", "binary": "binary",
}


def spark_type(name: str) -> str:
    """Mapping type name → Spark DDL type (unknown names pass through)."""
    return TYPE_ALIASES.get(name.strip().lower(), name)


def safe_cast(col: Column | str, type_name: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(spark_type(type_name))


def path_col(path: str) -> Column:
    """Column for a dotted path into nested structs (``a.b.c``); a top-level
    name that itself contains dots is addressed with backticks."""
    return F.col(path) if "." in path else F.col(f"`{path}`")


def apply_mapping(df: DataFrame,
                  mappings: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """One projection: output has exactly the listed targets, in list order.

    Each mapping is ``(source_path, source_type, target, target_type)``; the
    source path may address nested struct fields; a dotted target builds a
    nested struct. Casts never fail (bad → NULL).
    """
    top: dict[str, object] = {}
    order: list[str] = []
    for src, _stype, dst, dtype in mappings:
        value = safe_cast(_resolve(df, src), dtype)
        parts = dst.split(".")
        node = top
        if parts[0] not in order:
            order.append(parts[0])
        for p in parts[:-1]:
            node = node.setdefault(p, {})  # type: ignore[assignment]
        node[parts[-1]] = value  # type: ignore[index]
    return df.select([_build(top[name]).alias(name) for name in order])


def _resolve(df: DataFrame, src: str) -> Column:
    if src in df.columns:
        return F.col(f"`{src}`")
    return F.col(src)


def _build(node) -> Column:
    if isinstance(node, dict):
        return F.struct(*[_build(v).alias(k) for k, v in node.items()])
    return node
