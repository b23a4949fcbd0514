"""Row-set operators: dedupe by key, latest per key, union, upsert merge.

"One row per key" is computed as an aggregate (``min``/``max`` of a struct
whose leading fields are the ordering columns) rather than a
``row_number()`` window: the aggregate is combined map-side, so a key that
holds a third of all rows is reduced in every task before the shuffle
instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None,
              largest: bool) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by else rest
    tail = [c for c in rest if c not in order]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(f"t{i}") for i, c in enumerate(tail)]
    agg = F.max if largest else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"))
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_pick.o{i}").alias(c) for i, c in enumerate(order) if c not in keys]
    cols += [F.col(f"_pick.t{i}").alias(c) for i, c in enumerate(tail)]
    return picked.select(*cols).select(*df.columns)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order_by`` (default: all other
    columns, so the choice is reproducible; NULLs sort first)."""
    return _pick_one(df, keys, order_by, largest=False)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the row with the largest ``order_by`` tuple per key."""
    return _pick_one(df, keys, order_by, largest=True)


def union_frames(*dfs: DataFrame, by_name: bool = True, allow_missing: bool = True) -> DataFrame:
    """Union of frames (``union``): by name, missing columns filled with NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = (out.unionByName(d, allowMissingColumns=allow_missing) if by_name
               else out.union(d))
    return out


def merge_upsert(source: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: staged rows replace source rows with the same keys, new keys
    are inserted, other source rows are kept. Duplicate keys on one side pass
    through as they are; NULL keys are equal to each other. One shuffle on the keys (anti join) plus a union.

    The staged keys are made distinct first: the partial aggregate collapses
    a key repeated many times in the stage inside each task, and the join
    reuses the aggregate's hash partitioning, so this costs no extra shuffle
    (AQE can split only the left side of an anti join when a key is hot)."""
    keys = list(keys)
    # structs compare NULL fields as equal, and the distinct and the join then
    # share one partitioning (a null-safe condition would shuffle once more)
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    stage_keys = stage.select(key.alias("_staged")).distinct()
    kept = source.join(stage_keys, on=key == F.col("_staged"), how="left_anti")
    return kept.unionByName(stage.select(*source.columns))


def split_rows(df: DataFrame, condition: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy / do not satisfy ``condition``; NULL counts as "not",
    so the two parts partition the input."""
    c = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(c), df.filter(~F.coalesce(c, F.lit(False)))
