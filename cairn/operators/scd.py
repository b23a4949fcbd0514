"""Slowly changing dimensions, type 1 / 2 / 3, applied one change batch at a time.

All three are joins on the business key plus unions — no window over a key,
so a key with many versions never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _changed(t: DataFrame, s: DataFrame, attrs: Sequence[str]):
    cond = None
    for a in attrs:
        e = ~F.col(f"t.{a}").eqNullSafe(F.col(f"s.{a}"))
        cond = e if cond is None else cond | e
    return cond


def _one_change(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One change per key: equal rows count once, different ones raise when the
    result is computed. Combined map-side, and on the join's own partitioning."""
    rest = [c for c in changes.columns if c not in keys]
    if not rest:
        return changes.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    least, most = F.col("_least"), F.col("_most")
    one = F.when(least.eqNullSafe(most), least).otherwise(
        F.raise_error(F.lit(f"different changes for one key of {', '.join(keys)}")))
    return (changes.groupBy(*keys).agg(F.min(row).alias("_least"), F.max(row).alias("_most"))
            .select(*keys, one.alias("_row")).select(*keys, "_row.*"))


def scd1(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type 1: overwrite attributes in place (also with NULL); new keys inserted."""
    keys = list(keys)
    attrs = [c for c in target.columns if c not in keys]
    t, s = target.alias("t"), _one_change(changes, keys).withColumn("_staged", F.lit(True)).alias("s")
    j = t.join(s, keys, "full")
    staged = F.col("s._staged").isNotNull()
    return j.select(*keys, *[F.when(staged, F.col(f"s.{a}")).otherwise(F.col(f"t.{a}")).alias(a)
                             if a in changes.columns else F.col(f"t.{a}") for a in attrs])


def scd2(history: DataFrame, changes: DataFrame, keys: Sequence[str], attrs: Sequence[str],
         effective: str, from_col: str = "valid_from", to_col: str = "valid_to",
         current_col: str = "is_current") -> DataFrame:
    """Type 2: a changed key's current version is closed at ``effective`` and
    a new current version opened; new keys open a first version; unchanged
    keys and closed versions are kept as they are."""
    keys, attrs = list(keys), list(attrs)
    eff = F.lit(effective).cast(history.schema[from_col].dataType)
    cur = history.filter(F.col(current_col))
    old = history.filter(~F.col(current_col))
    t = cur.alias("t")
    s = (_one_change(changes.select(*keys, *attrs), keys)
         .withColumn("_staged", F.lit(True)).alias("s"))
    j = t.join(s, keys, "full")
    present_t = F.col(f"t.{current_col}").isNotNull()
    present_s = F.col("s._staged").isNotNull()
    changed = present_t & present_s & _changed(t, s, attrs)
    hist_t = {c: history.schema[c].dataType for c in history.columns}

    def version(src: str, start, end, current) -> "F.Column":
        return F.struct(*[F.col(f"{src}.{a}").alias(a) for a in attrs],
                        start.cast(hist_t[from_col]).alias(from_col),
                        end.cast(hist_t[to_col]).alias(to_col),
                        current.alias(current_col))

    t_from, t_to = F.col(f"t.{from_col}"), F.col(f"t.{to_col}")
    # one pass over the join: each joined row emits the versions it yields
    kept = F.when(present_t & ~changed, version("t", t_from, t_to, F.col(f"t.{current_col}")))
    closed = F.when(changed, version("t", t_from, eff, F.lit(False)))
    opened = F.when(changed | (~present_t & present_s),
                    version("s", eff, F.lit(None), F.lit(True)))
    current_rows = (j.select(*keys, F.explode(F.array(kept, closed, opened)).alias("_v"))
                    .filter(F.col("_v").isNotNull())
                    .select(*keys, "_v.*"))
    cols = history.columns
    return old.select(*cols).unionByName(current_rows.select(*cols))


def scd3(target: DataFrame, changes: DataFrame, keys: Sequence[str], attr: str,
         prev_col: str | None = None) -> DataFrame:
    """Type 3: the current value is overwritten and the value it replaced is
    kept in ``prev_<attr>``; unchanged rows keep their previous value. A staged
    NULL is a value like any other."""
    keys = list(keys)
    prev_col = prev_col or f"prev_{attr}"
    if prev_col not in target.columns:
        target = target.withColumn(prev_col, F.lit(None).cast(target.schema[attr].dataType))
    others = [c for c in target.columns if c not in keys and c not in (attr, prev_col)]
    t = target.withColumn("_known", F.lit(True)).alias("t")
    s = _one_change(changes, keys).withColumn("_staged", F.lit(True)).alias("s")
    j = t.join(s, keys, "full")
    sv, tv = F.col(f"s.{attr}"), F.col(f"t.{attr}")
    staged = F.col("s._staged").isNotNull()
    changed = staged & F.col("t._known").isNotNull() & ~tv.eqNullSafe(sv)
    return j.select(
        *keys,
        *[F.when(staged, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in changes.columns
          else F.col(f"t.{c}").alias(c) for c in others],
        F.when(staged, sv).otherwise(tv).alias(attr),
        F.when(changed, tv).otherwise(F.col(f"t.{prev_col}")).alias(prev_col))
