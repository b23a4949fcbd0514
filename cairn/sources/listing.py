"""Listings of folder trees by the executors.

A work queue of folders goes round: each round lists the folders that the
round before found, one row a folder, in as many tasks as there is work for.
The driver only asks whether folders are left, once per depth of the tree.
Executors list with pyarrow's file systems (local, HDFS, S3, GCS); a store
that only the JVM reaches cannot be listed this way and raises.
"""

from __future__ import annotations

import fnmatch
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import scratch

SCHEMA = "path string, folder boolean, length long, mtime timestamp"
#: Schemes that executors can list themselves.
SCHEMES = ("file", "hdfs", "s3", "gs")


def _split(uri: str) -> tuple[str, str]:
    """(scheme and host, path) of a Hadoop URI, whose path is not encoded."""
    scheme, rest = uri.split(":", 1)
    if not rest.startswith("//"):
        return f"{scheme}://", rest
    host, _, path = rest[2:].partition("/")
    return f"{scheme}://{host}", "/" + path


def _list(uri: str):
    """(path, is a folder, length, modification time) of what lies in a folder; nothing if it is gone."""
    from pyarrow import fs

    base, path = _split(uri)
    store, inner = fs.FileSystem.from_uri(base + quote(path))
    for x in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if not x.base_name.startswith(("_", ".")):
            yield f"{base}{path.rstrip('/')}/{x.base_name}", x.type == fs.FileType.Directory, x.size or 0, x.mtime


def _children(batches):
    for b in batches:
        for uri in b.column("path").to_pylist():
            rows = list(_list(uri))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "folder", "length", "mtime"])


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and host, as Hadoop writes it."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API, metadata only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()  # noqa: SLF001


def list_tree(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, mtime) of all files below a folder, empty ones included;
    names that begin with ``_`` or ``.`` are hidden. A folder that is not
    there, or goes while it is listed, has no files.

    Each folder is listed by one task (a listing is a stream by nature); the
    rounds are written, so a lost executor repeats one round's share at most.
    """
    root = qualified(spark, path)
    if root.split(":", 1)[0] not in SCHEMES:
        raise ValueError(f"executors cannot list {root}")
    at = scratch(spark, "listing")
    queue = spark.createDataFrame([(root,)], "path string")
    rounds = []
    while rounds == [] or not queue.isEmpty():
        # folders are dealt out evenly, however they lie in the tree
        spread = queue.repartition(spark.sparkContext.defaultParallelism, "path") if rounds else queue
        out = f"{at}/{len(rounds)}"
        spread.mapInArrow(_children, SCHEMA).write.parquet(out)
        rounds.append(out)
        queue = spark.read.schema(SCHEMA).parquet(out).where("folder").select("path")
    files = spark.read.schema(SCHEMA).parquet(*rounds).where("NOT folder")
    if glob is not None:
        files = files.where(F.regexp_extract("path", "([^/]+)$", 1).rlike(fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")))
    return files.select("path", "length", "mtime")
