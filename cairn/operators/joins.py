"""Equi-joins by key lists (``Join(frame1, frame2, keys1, keys2)``).

Both key columns are kept. A right-side column whose name also exists on the
left is renamed ``.<name>`` (our contract; the reference does not say).
The physical strategy is Catalyst's: with AQE a side is broadcast only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold``; skewed
partitions of a sort-merge join are split at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_frames(left: DataFrame, right: DataFrame, keys1: Sequence[str],
                keys2: Sequence[str], how: str = "inner") -> DataFrame:
    if len(keys1) != len(keys2):
        raise ValueError("keys1 and keys2 must have the same length")
    la = left.alias("_l")
    ren = {c: (f".{c}" if c in left.columns else c) for c in right.columns}
    ra = right.select([F.col(c).alias(ren[c]) for c in right.columns]).alias("_r")
    cond = None
    for a, b in zip(keys1, keys2):
        e = F.col(f"_l.`{a}`") == F.col(f"_r.`{ren[b]}`")
        cond = e if cond is None else cond & e
    out = la.join(ra, cond, how)
    return out.select([F.col(f"_l.`{c}`") for c in left.columns]
                      + [F.col(f"_r.`{ren[c]}`") for c in right.columns])
