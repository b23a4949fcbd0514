"""Schema evolution: differences between two schemas, and union of frames
whose columns drifted (new columns filled with NULL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def schema_diff(old: T.StructType, new: T.StructType) -> dict:
    """{"added": [...], "removed": [...], "changed": [(name, old_type, new_type)]}."""
    o = {f.name: f.dataType for f in old.fields}
    n = {f.name: f.dataType for f in new.fields}
    return {
        "added": [k for k in n if k not in o],
        "removed": [k for k in o if k not in n],
        "changed": [(k, o[k].simpleString(), n[k].simpleString())
                    for k in o if k in n and o[k] != n[k]],
    }


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing in a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
