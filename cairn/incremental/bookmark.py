"""Job bookmarks: incremental loads that remember what was read.

State is a manifest table (Parquet, append-only) in the shared checkpoint
folder, one row per file a job has committed:
``(job, source, kind, path, mtime, length, high_water, run_id, committed_at)``.
``kind`` is ``file``, ``key`` (high-water mark of a table source) or
``reset`` (everything before it is forgotten).

* a file counts as seen when (path, mtime, length) is in the manifest, so a
  rewritten file is read again;
* ``commit()`` appends only after the caller's sink finished: a failed or
  uncommitted run leaves the state as it was and the next run sees the same
  delta again; ``append()`` is sink and commit in one step (below);
* modes: ``enable`` (track), ``disable`` (read all, no state), ``pause``
  (read all, state kept unchanged).

File deltas stay on the cluster: the listing (``_metadata`` of the files) is
anti-joined with the manifest and written as the run's own manifest rows; the
scan is bounded by the least and the largest modification time among them, and
its rows are matched to them by ``_metadata``. Only these two times and a count
reach the driver, however many files there are. A file that arrives between
the listing and the scan is not among the run's rows and waits for the next.

A run's manifest rows are staged below ``_staged`` and appear by the rename of
one folder. ``append(df, target)`` stages the rows of a batch too and renames
both under one commit record: a crash before the record leaves nothing, one
after it is carried through by the next run. Runs of one job take turns.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import path_exists
from cairn.sinks.files import write_frame
from cairn.sinks.publish import Commit, recover

MANIFEST_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("high_water", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

MODES = ("enable", "disable", "pause")


class Bookmark:
    def __init__(self, spark: SparkSession, state_path: str, job: str, mode: str = "enable"):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.spark, self.state_path, self.job, self.mode = spark, state_path, job, mode
        self.run_id = uuid.uuid4().hex[:12]
        self._staged = f"{state_path}/_staged/{self.run_id}"
        self._pending = False
        self._log = f"{state_path}/_commits"
        recover(spark, self._log)

    # -- state -------------------------------------------------------------
    def _manifest(self) -> DataFrame:
        if not path_exists(self.spark, self.state_path):  # no state written yet
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return (self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True)
                .parquet(self.state_path))

    def _stage(self, rows: DataFrame) -> None:
        """Add manifest rows that appear with this run's commit."""
        rows.select(MANIFEST_SCHEMA.names).write.mode("append").parquet(self._staged)
        self._pending = True

    def _live(self, source: str) -> DataFrame:
        """Manifest rows of this job/source after its latest reset."""
        m = self._manifest().filter((F.col("job") == self.job) & (F.col("source") == source))
        last_reset = (m.filter(F.col("kind") == "reset")
                      .agg(F.max("seq").alias("r")).first().r)  # one number
        live = m.filter(F.col("kind") != "reset")
        return live if last_reset is None else live.filter(F.col("seq") > F.lit(last_reset))

    def state(self) -> DataFrame:
        """What the bookmark holds for this job (after resets)."""
        m = self._manifest().filter(F.col("job") == self.job)
        resets = m.filter(F.col("kind") == "reset").groupBy("source").agg(F.max("seq").alias("r"))
        return (m.join(resets, "source", "left")
                .filter(F.col("r").isNull() | (F.col("seq") > F.col("r")))
                .filter(F.col("kind") != "reset").drop("r"))

    def reset(self, source: str | None = None) -> None:
        """Forget everything read so far (for one source or all of this job's)."""
        sources = [source] if source else [r.source for r in
                                           self._manifest().filter(F.col("job") == self.job)
                                           .select("source").distinct().collect()]
        rows = [(self.job, s, "reset", None, None, None, None, self.run_id, _seq())
                for s in sources]
        if rows:
            reset = Bookmark(self.spark, self.state_path, self.job)
            reset._stage(self.spark.createDataFrame(rows, MANIFEST_SCHEMA))
            reset.commit()

    # -- file sources ------------------------------------------------------
    def new_files(self, source: str, glob: str | None = None) -> DataFrame:
        """Listing of files not yet committed (all files unless enabled)."""
        listing = _located(_options(self.spark.read.format("binaryFile"), glob).load(source)).select(*_FILE)
        if self.mode != "enable":
            return listing
        seen = self._live(source).select("path", "mtime", "length")
        return listing.join(seen, ["path", "mtime", "length"], "left_anti")

    def scan_new(self, reader: DataFrameReader, source: str, glob: str | None = None) -> DataFrame:
        """Rows of the unseen files as ``reader`` reads them, with each row's
        file (``path``, ``mtime``, ``length``) in the struct ``_file``. The
        files are staged for the next commit, whether or not they hold rows."""
        if self.mode != "enable":
            return _with_file(_options(reader, glob).load(source))
        fixed = [F.lit(self.job).alias("job"), F.lit(source).alias("source"), F.lit("file").alias("kind"),
                 F.lit(None).cast("string").alias("high_water"), F.lit(self.run_id).alias("run_id"), F.lit(_seq()).alias("seq")]
        files = f"{self._staged}/files-{uuid.uuid4().hex[:8]}"
        self.new_files(source, glob).select("path", "mtime", "length", *fixed).select(MANIFEST_SCHEMA.names).write.parquet(files)
        self._pending = True
        own = self.spark.read.schema(MANIFEST_SCHEMA).parquet(files).select(*_FILE)
        span = own.agg(F.min("mtime").alias("a"), F.max("mtime").alias("b")).select(
            F.date_format(F.col("a") - F.expr("INTERVAL 1 SECOND"), _TIME), F.date_format(F.col("b") + F.expr("INTERVAL 2 SECONDS"), _TIME)).first()
        reader = _options(reader, glob)
        if span[0] is not None:
            reader = reader.option("modifiedAfter", span[0]).option("modifiedBefore", span[1])
        rows = _with_file(reader.load(source))
        own = own.select(F.struct(*_FILE).alias("_own"))
        return rows.join(own, F.col("_file") == F.col("_own"), "left_semi")

    def read_new(self, source: str, fmt: str, schema: T.StructType | str,
                 glob: str | None = None, **options) -> DataFrame:
        """Rows of the unseen files (an empty frame with ``schema`` when none).
        Remember to ``commit()`` after the sink succeeded, or hand the rows to
        ``append()``."""
        r = self.spark.read.format(fmt).schema(schema)
        for k, v in options.items():
            r = r.option(k, v)
        return self.scan_new(r, source, glob).drop("_file")

    # -- table sources (key / timestamp high-water mark) -------------------
    def read_by_key(self, df: DataFrame, source: str, key: str) -> DataFrame:
        """Rows with ``key`` above the committed high-water mark.

        The new mark is fixed here, by one aggregate over the key column, and
        bounds the rows returned: a row that arrives between the sink and the
        commit stays above the mark for the next run. ``pause`` and
        ``disable`` return all rows. Rows without a key cannot be ordered:
        only the first run, with no mark yet, returns them."""
        if self.mode != "enable":
            return df
        row = (self._live(source).filter(F.col("kind") == "key")
               .orderBy(F.desc("seq")).select("high_water").first())
        dtype = df.schema[key].dataType
        k = F.col(f"`{key}`")
        delta = df if row is None else df.filter(k > F.lit(row.high_water).cast(dtype))
        top = delta.agg(F.max(k).cast("string").alias("top")).first().top  # one value
        if top is None:
            return delta.filter(k.isNull())
        self._stage(self.spark.createDataFrame(
            [(self.job, source, "key", None, None, None, top, self.run_id, _seq())], MANIFEST_SCHEMA))
        upto = k <= F.lit(top).cast(dtype)
        return delta.filter(upto | k.isNull()) if row is None else delta.filter(upto)

    def commit(self) -> None:
        """Record what this run read. Call after the sink has finished."""
        self._finish([])

    def append(self, df: DataFrame, target: str, fmt: str = "parquet", **options) -> str:
        """Append a batch to ``target`` and record what this run read, in one
        step: the rows lie below ``target/batch=<run>`` (``batch`` is a column
        for readers of the whole target). Returns the batch's folder."""
        staged, final = f"{target}/_staged/{self.run_id}", f"{target}/batch={self.run_id}"
        write_frame(df, staged, fmt, **options)
        self._finish([(staged, final)])
        return final

    def _finish(self, moves: list[tuple[str, str]]) -> None:
        if self.mode == "enable" and self._pending:
            moves = [*moves, (self._staged, f"{self.state_path}/run-{self.run_id}")]
        if moves:
            commit = Commit(self.spark, self._log, self.run_id, moves)
            commit.record()
            commit.finish()
        # a run that goes on after its commit is another run
        self.run_id = uuid.uuid4().hex[:12]
        self._staged, self._pending = f"{self.state_path}/_staged/{self.run_id}", False


_FILE = ("path", "mtime", "length")
_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def _options(reader: DataFrameReader, glob: str | None) -> DataFrameReader:
    reader = reader.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _located(df: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return df.select(meta["file_path"].alias("path"), meta["file_modification_time"].alias("mtime"), meta["file_size"].alias("length"))


def _with_file(df: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return df.select("*", F.struct(meta["file_path"].alias("path"), meta["file_modification_time"].alias("mtime"),
                                   meta["file_size"].alias("length")).alias("_file"))


def _seq() -> int:
    # monotonic commit order across runs (nanoseconds since the epoch)
    return time.time_ns()
