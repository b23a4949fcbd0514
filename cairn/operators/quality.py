"""Data quality rules: not-null, range, membership (enum), uniqueness.

``quality_report`` evaluates every row-level rule in one aggregate pass
(``count_if`` per rule, combined map-side); a uniqueness rule adds one
aggregation on its key. ``quarantine`` splits the rows that break any rule
(with the names of the rules they break) from the clean rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str                   # not_null | range | in_set | unique
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    values: tuple = field(default_factory=tuple)

    def violation(self) -> Column:
        """TRUE where a row breaks the rule (row-level rules only)."""
        c = F.col(self.columns[0])
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "range":
            ok = F.lit(True)
            if self.low is not None:
                ok = ok & (c >= F.lit(self.low))
            if self.high is not None:
                ok = ok & (c <= F.lit(self.high))
            return c.isNotNull() & ~ok
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.values))
        raise ValueError(f"{self.kind} is not a row-level rule")


def not_null(col: str) -> Rule:
    return Rule(f"not_null({col})", "not_null", (col,))


def in_range(col: str, low=None, high=None) -> Rule:
    return Rule(f"range({col})", "range", (col,), low=low, high=high)


def in_set(col: str, values: Sequence) -> Rule:
    """Membership check: the ``Enum`` type's fixed value set."""
    return Rule(f"in_set({col})", "in_set", (col,), values=tuple(values))


def unique(*cols: str) -> Rule:
    return Rule(f"unique({','.join(cols)})", "unique", tuple(cols))


def _dup_keys(df: DataFrame, rule: Rule) -> DataFrame:
    return (df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, n_checked, n_failed, passed) per rule."""
    spark = df.sparkSession
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = []
    if row_rules:
        aggs = [F.count(F.lit(1)).alias("_total")]
        aggs += [F.count_if(r.violation()).alias(f"_r{i}") for i, r in enumerate(row_rules)]
        one = df.agg(*aggs)
        stack = [x for i, r in enumerate(row_rules) for x in (F.lit(r.name), F.col(f"_r{i}"))]
        parts.append(one.select(F.col("_total").alias("n_checked"),
                                F.stack(F.lit(len(row_rules)), *stack).alias("rule", "n_failed")))
    for r in rules:
        if r.kind != "unique":
            continue
        # one pass: rows per key, then total rows and rows whose key repeats
        per_key = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_checked"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_failed"),
        ).select("n_checked", F.lit(r.name).alias("rule"), "n_failed"))
    if not parts:
        return spark.createDataFrame([], "rule string, n_checked bigint, n_failed bigint, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule", "n_checked", F.col("n_failed").cast("bigint").alias("n_failed"),
                      (F.col("n_failed") == 0).alias("passed"))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with ``failed_rules`` text)."""
    tagged = df
    flags = []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            # NULL keys count as equal, as in the report
            dups = _dup_keys(df, r).select(
                *[F.col(f"`{c}`").alias(f"_u{i}_{n}") for n, c in enumerate(r.columns)],
                F.lit(True).alias(f"_u{i}"))
            same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_u{i}_{n}")) for n, c in enumerate(r.columns)]
            tagged = tagged.join(dups, same, "left")
            flags.append(F.when(F.coalesce(F.col(f"_u{i}"), F.lit(False)), F.lit(r.name)))
        else:
            flags.append(F.when(r.violation(), F.lit(r.name)))
    failed = F.concat_ws(";", *flags)
    tagged = tagged.withColumn("failed_rules", failed)
    cols = df.columns
    good = tagged.filter(F.col("failed_rules") == "").select(*cols)
    bad = tagged.filter(F.col("failed_rules") != "").select(*cols, "failed_rules")
    return good, bad
