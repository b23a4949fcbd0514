"""Session, table loading and shared scratch locations.

Nothing here holds data on the driver. Scratch output (tables written by a
job, bookmark manifests, streaming checkpoints) always lives under the
folder the cluster names in ``spark.checkpoint.dir``; a private folder is
only created when that setting is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Settings a job relies on; applied by ``build_session`` and safe on a cluster.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # dynamic partition overwrite only replaces the partitions a run touches
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "cairn",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UTC clock and the web UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan.

    The table schema is looked up once per session (as a metastore would hold
    it) instead of running a footer-reading job on every read; the key
    includes the path's modification time and size, so a rewritten table is
    inspected again. A single-file table is read into one DataFrame per
    session and version of the file (read once, reuse: no re-listing and
    re-analysis per query); a folder is listed afresh on every call, since a
    file added below it need not change the folder's own timestamp.
    """
    path = table_path(sf_dir, name)
    mtime, length, is_file = _path_stamp(spark, path)
    key = (path, mtime, length)
    frames = _FRAMES.setdefault(spark, {})
    if is_file and key in frames:
        return frames[key]
    schema = frames.get(("schema", *key))
    if schema is None:
        schema = frames[("schema", *key)] = spark.read.parquet(path).schema
    df = spark.read.schema(schema).parquet(path)
    if is_file:
        frames[key] = df
    return df


# per session object: table schemas and single-file table frames (a few
# small entries per table; a new session starts with none)
_FRAMES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _path_stamp(spark: SparkSession, path: str) -> tuple[int, int, bool]:
    """(modification time, length, is a file) of a path (one metadata call)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    st = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)  # noqa: SLF001
    return st.getModificationTime(), st.getLen(), st.isFile()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (a shared file system all
    executors see); unset on a cluster, this raises. Only in local runs and
    tests a private folder is created and registered, so later calls agree on it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            conf = None
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="cairn-ckpt-")
    sc.setCheckpointDir(conf)
    # Spark appends a per-application folder; use that one.
    return sc.getCheckpointDir() or conf


def scratch(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    base = checkpoint_root(spark)
    return _join(base, "cairn-scratch", *parts, uuid.uuid4().hex[:12])


def _join(base: str, *parts: str) -> str:
    base = base.rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts if p]])


def unique_name(prefix: str) -> str:
    """Catalog-safe unique identifier (database / table names)."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (Hadoop FileSystem API; metadata only)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def size_shuffles(spark: SparkSession, input_bytes: int, total_cores: int,
                  target_partition_bytes: int = 256 << 20) -> int:
    """Size shuffles for an input of ``input_bytes`` on ``total_cores``.

    Start with enough shuffle partitions that each holds about
    ``target_partition_bytes`` (never fewer than 3 per core) and let AQE
    coalesce the small ones and split skewed ones at run time; scan splits
    use the same target. Returns the partition count it set.
    """
    n = max(total_cores * 3, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(target_partition_bytes, 512 << 20)))
    return n
