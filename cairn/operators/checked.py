"""Error sets for JVM-side stages, and counts per stage.

A checked frame passes through any number of named stages of casts and rules.
A record that fails one goes to the error set as ``(stage, message, record)``,
with the record as it entered that stage, and takes no part in later stages.
Everything is column expressions, so all stages are one projection; ``run``
evaluates them once, writes good and failed records together, and takes the
counts per stage from observed metrics of that write.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cairn.functions.casting import path_col, safe_cast, spark_type

ERR_COL = "__error"
_ERR_TYPE = "struct<stage:string,message:string,record:string>"


@dataclass(frozen=True)
class StageCount:
    """Records that reached a stage, and those that failed in it."""

    seen: int
    errors: int


@dataclass
class Outcome:
    """Written result of a checked frame.

    ``frame``: the good records; ``errors``: (stage, message, record) of the
    others; ``counts``: per stage, in order.
    """

    frame: DataFrame
    errors: DataFrame
    counts: dict[str, StageCount]

    def stage_errors_count(self, stage: str) -> int:
        """Records that failed in one stage."""
        return self.counts[stage].errors

    def errors_count(self) -> int:
        """Records that failed in any stage."""
        return sum(c.errors for c in self.counts.values())

    def assert_error_threshold(self, max_errors: int) -> "Outcome":
        """Raise when more than ``max_errors`` records failed."""
        if (n := self.errors_count()) > max_errors:
            raise RuntimeError(f"{n} error records exceed threshold {max_errors}")
        return self


class Checked:
    """A frame on its way through named stages; each returns a new one."""

    def __init__(self, df: DataFrame, _stages: tuple[str, ...] = ()):
        if not _stages and ERR_COL in df.columns:
            raise ValueError(f"{ERR_COL} is reserved for the error set")
        self._df = df if _stages else df.withColumn(ERR_COL, F.lit(None).cast(_ERR_TYPE))
        self._stages = _stages

    def _columns(self) -> list[str]:
        return [c for c in self._df.columns if c != ERR_COL]

    def _failing(self, stage: str, messages: Sequence[Column]) -> Column:
        """The error of a record: the one it has, or this stage's messages (NULL where there is none)."""
        if stage in self._stages:
            raise ValueError(f"two stages are named {stage}")
        message = F.concat_ws("; ", *messages)
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in self._columns()]))
        own = F.when(message != "", F.struct(F.lit(stage).alias("stage"), message.alias("message"), record.alias("record")))
        return F.coalesce(ERR_COL, own).alias(ERR_COL)

    def cast(self, mappings: Sequence[tuple[str, str, str, str]], stage: str = "cast") -> "Checked":
        """Project to the mappings' targets, like ``apply_mapping``; a value
        that its type cannot hold fails the record instead of becoming NULL."""
        values, messages = [], []
        for src, _, dst, kind in mappings:
            c = F.col(f"`{src}`") if src in self._df.columns else path_col(src)
            v = safe_cast(c, kind)
            values.append(v.alias(dst))
            messages.append(F.when(c.isNotNull() & v.isNull(), F.concat(
                F.lit(f"{src}: "), c.cast("string"), F.lit(f" is no {spark_type(kind)}"))))
        return Checked(self._df.select(*values, self._failing(stage, messages)), (*self._stages, stage))

    def require(self, rules: Mapping[str, Column | str], stage: str = "rules") -> "Checked":
        """Records must satisfy every rule, given as message → condition; NULL fails."""
        ok = {m: F.expr(c) if isinstance(c, str) else c for m, c in rules.items()}
        messages = [F.when(~F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in ok.items()]
        names = [F.col(f"`{c}`") for c in self._columns()]
        return Checked(self._df.select(*names, self._failing(stage, messages)), (*self._stages, stage))

    def run(self, path: str) -> Outcome:
        """Evaluate every stage once: one job writes the records to ``path``
        (good and failed apart, as partitions) and counts them per stage.

        The metric is taken in the writing stage itself, so a task that runs
        again after a lost executor is counted once.
        """
        obs = Observation(f"checked_{uuid.uuid4().hex[:8]}")
        failed = F.col(ERR_COL)["stage"]
        metrics = [F.count(F.lit(1)).alias("n")] + [F.count_if(failed == s).alias(f"s{i}") for i, s in enumerate(self._stages)]
        both = self._df.withColumn("__failed", F.col(ERR_COL).isNotNull()).observe(obs, *metrics)
        both.write.mode("overwrite").partitionBy("__failed").parquet(path)
        got, counts = obs.get, {}
        left = int(got["n"])
        for i, s in enumerate(self._stages):
            counts[s] = StageCount(left, int(got[f"s{i}"]))
            left -= counts[s].errors
        written = self._df.sparkSession.read.schema(both.schema).parquet(path)
        good = written.where(~F.col("__failed")).select(*[F.col(f"`{c}`") for c in self._columns()])
        bad = written.where("__failed").select(f"{ERR_COL}.*")
        return Outcome(good, bad, counts)
