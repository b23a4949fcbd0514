"""Python row functions (``map``, ``mapPartitions``, ``mapPartitionsWithIndex``)
with an error set instead of job failure, and ``spigot``.

Python only runs where the caller hands in Python: batches cross the JVM
boundary as Arrow record batches (``mapInArrow``), never through pandas, which
would turn a BIGINT beside a NULL into a double. A record whose function raises
is not lost and does not kill the task: it goes to the error frame as
``(stage, message, record)`` with the record as JSON text.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ERR_COL = "__error"


@dataclass
class MappedFrame:
    """Result of a row function: good rows and the error set."""

    frame: DataFrame
    errors: DataFrame
    stage: str
    combined: DataFrame | None = None
    observed_errors: int | None = None

    def write(self, path: str, fmt: str = "parquet", **options) -> int:
        """Write the good rows to ``path`` and return the number of error
        records, taken from an observed metric of the same job: the function
        runs once, and ``errors_count`` / ``assert_error_threshold`` then need
        no second pass."""
        from cairn.sinks.files import write_frame
        if self.combined is None:
            write_frame(self.frame, path, fmt, **options)
            return self.errors_count()
        obs = Observation(f"{self.stage}_errors_{uuid.uuid4().hex[:8]}")
        both = self.combined.observe(obs, F.count_if(F.col(ERR_COL).isNotNull()).alias("n"))
        names = [c for c in both.columns if c != ERR_COL]
        write_frame(_split_errors(both, names, self.stage).frame, path, fmt, **options)
        self.observed_errors = int(obs.get["n"])
        return self.observed_errors

    def materialize(self, path: str) -> "MappedFrame":
        """Run the Python function once: write good and bad rows together to
        ``path`` (a shared folder) and derive both frames from the written
        table — otherwise using both sides evaluates the function twice."""
        if self.combined is None:
            return self
        self.combined.write.mode("overwrite").parquet(path)
        both = self.combined.sparkSession.read.parquet(path)
        names = [c for c in both.columns if c != ERR_COL]
        return _split_errors(both, names, self.stage)

    def errors_count(self) -> int:
        """Error records: the count observed by ``write`` when it ran, else one
        count job over the error frame."""
        if self.observed_errors is not None:
            return self.observed_errors
        return self.errors.count()

    def assert_error_threshold(self, max_errors: int) -> "MappedFrame":
        """Raise when more than ``max_errors`` records failed (one count job)."""
        n = self.errors_count()
        if n > max_errors:
            raise RuntimeError(f"{self.stage}: {n} error records exceed threshold {max_errors}")
        return self


def _plain(v):
    """A record as JSON-ready values; non-finite numbers become text."""
    if isinstance(v, dict):
        return {str(k): _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if isinstance(v, float) and not math.isfinite(v):
        return str(v)
    if v is None or isinstance(v, (str, int, float)):
        return v
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


ERR_TYPE = T.StructType([T.StructField("message", T.StringType()),
                         T.StructField("record", T.StringType())])
_RUN = 4096  # copies of one record that a spigot counts together
_CHUNK = 10_000  # rows per outgoing Arrow batch; results do not depend on it


def _output(schema: T.StructType | str) -> tuple[list[str], T.StructType]:
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema  # noqa: SLF001
    names = out.fieldNames()
    if ERR_COL in names:
        raise ValueError(f"{ERR_COL} is reserved for the error set")
    # error rows hold NULL in every column, whatever the caller's schema says
    fields = [T.StructField(f.name, f.dataType, True) for f in out.fields]
    return names, T.StructType(fields + [T.StructField(ERR_COL, ERR_TYPE)])


def _failed(rec: dict | None, ex: Exception | str) -> dict:
    message = ex if isinstance(ex, str) else f"{type(ex).__name__}: {ex}"
    return {ERR_COL: {"message": message,
                      "record": None if rec is None else json.dumps(_plain(rec))}}


def _to_batches(results: Iterator[tuple[dict, dict]], schema) -> Iterator[pa.RecordBatch]:
    """(input record, output row) pairs → Arrow batches; a row that does not
    fit the output schema goes to the error set with its record."""
    while chunk := list(itertools.islice(results, _CHUNK)):
        try:
            yield pa.RecordBatch.from_pylist([row for _, row in chunk], schema=schema)
        except Exception:  # noqa: BLE001 - find the rows that do not fit
            rows = []
            for rec, row in chunk:
                try:
                    pa.RecordBatch.from_pylist([row], schema=schema)
                    rows.append(row)
                except Exception as ex:  # noqa: BLE001
                    rows.append(_failed(rec, ex))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType | str,
             stage: str = "map") -> MappedFrame:
    """Apply ``fn(record: dict) -> dict`` to each record (``map``). Values reach
    it unchanged: NULL is None, BIGINT an exact int."""
    names, out_schema = _output(schema)
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            for batch in batches:
                for rec in batch.to_pylist():
                    try:
                        r = fn(dict(rec))
                        row = {k: r.get(k) for k in names}
                    except Exception as ex:  # noqa: BLE001 - error set, by design
                        row = _failed(rec, ex)
                    yield rec, row
        return _to_batches(results(), arrow)

    return _split_errors(df.mapInArrow(run, out_schema), names, stage)


def map_partitions(df: DataFrame, fn: Callable[..., Iterable[dict]],
                   schema: T.StructType | str, stage: str = "mapPartitions",
                   with_index: bool = False) -> MappedFrame:
    """Apply ``fn(records) -> iterable of dicts`` once to each whole partition
    (``mapPartitions``); with ``with_index`` it is called as ``fn(pid, records)``
    (``mapPartitionsWithIndex``). ``records`` is an iterator, so a partition of
    any size passes through in bounded memory.

    When ``fn`` raises, the record it took last goes to the error set and
    ``fn`` is called again on the records that are left: one bad record costs
    only itself. A function that carries state from record to record should
    therefore catch its own errors. A function that raises before it takes a
    record sends every record left to the error set."""
    names, out_schema = _output(schema)
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        last: dict = {"rec": None, "ended": False, "upstream": None}

        def records():
            try:
                for batch in batches:
                    for rec in batch.to_pylist():
                        last["rec"] = rec
                        yield dict(rec)
            except Exception as ex:  # not the function's fault: the task fails
                last["upstream"] = ex
                raise
            last["ended"] = True

        def results():
            source = records()
            while True:
                last["rec"] = None
                try:
                    for r in (fn(pid, source) if with_index else fn(source)):
                        yield last["rec"], {k: r.get(k) for k in names}
                    return
                except Exception as ex:  # noqa: BLE001 - error set, by design
                    if last["upstream"] is not None:
                        raise
                    if last["rec"] is not None:
                        yield last["rec"], _failed(last["rec"], ex)
                    else:
                        for rec in source:
                            yield rec, _failed(rec, ex)
                    if last["ended"]:
                        return
        return _to_batches(results(), arrow)

    return _split_errors(df.mapInArrow(run, out_schema), names, stage)


def _split_errors(both: DataFrame, names: list[str], stage: str) -> MappedFrame:
    good = both.filter(F.col(ERR_COL).isNull()).select(*[F.col(f"`{n}`") for n in names])
    err = both.filter(F.col(ERR_COL).isNotNull()).select(
        F.lit(stage).alias("stage"),
        F.col(ERR_COL)["message"].alias("message"), F.col(ERR_COL)["record"].alias("record"))
    return MappedFrame(good, err, stage, both)


def spigot(df: DataFrame, path: str, fraction: float | None = None, top: int | None = None,
           seed: int = 42) -> DataFrame:
    """Write a sample of the records as JSON to ``path`` and return the frame
    unchanged (the sample is the feature; exactly one of the two is required).

    ``fraction`` keeps a record if a hash of its content lies below that share
    of the hashes; ``top`` keeps the records of the least hashes. Either way
    the sample depends on the records and ``seed`` alone, not on how they are
    split over partitions. Equal records are told apart by number: each copy
    of ``n`` has a hash of its own.

    Only hashes are counted for the whole frame; records are read again for
    the hashes that were chosen.
    """
    if (fraction is None) == (top is None):
        raise ValueError("give either fraction or top")
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    keyed = df.select(record.alias("value")).select(
        "value", F.xxhash64("value").alias("_h1"), F.xxhash64(F.lit(seed), "value").alias("_h2"))
    copies = keyed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    # a hash with many copies is spread in runs of them
    runs = copies.select("_h1", "_h2", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {_RUN})")).alias("_run"))
    of_run = F.sequence(F.col("_run") * _RUN, F.least(F.col("_run") * _RUN + (_RUN - 1), F.col("_n") - 1))
    each = runs.select("_h1", "_h2", F.explode(of_run).alias("_copy"))
    each = each.withColumn("_u", F.xxhash64("_h1", "_h2", "_copy"))
    if fraction is not None:
        each = each.where(F.col("_u") / float(1 << 64) + 0.5 < fraction)
    else:
        each = each.orderBy("_u", "_h1", "_h2", "_copy").limit(top)
    chosen = each.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_m"))
    found = keyed.join(chosen, ["_h1", "_h2"]).groupBy("value").agg(F.max("_m").alias("_m"))
    found.select("value", F.explode(F.sequence(F.lit(1), F.col("_m")))).select("value").write.mode("overwrite").text(path)
    return df
