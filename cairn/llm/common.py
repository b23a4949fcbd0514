"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import io
import weakref
import zipfile
from pathlib import Path

import cairn
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import scratch

_SHIPPED: "weakref.WeakSet[SparkContext]" = weakref.WeakSet()

#: Bytes of a batch that a function gets at once.
SLICE_BYTES = 4 << 20

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor never forces the work before it to run again.
    """
    path = scratch(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` whose functions may import this package on any executor.

    A function gets batches of some SLICE_BYTES, and what a task held is given
    back at its end: Spark keeps the workers for later tasks and stages, so
    what one of them holds on to would add to what the next one needs.
    """
    ship(df.sparkSession)

    def run(batches):
        try:
            yield from fn(sliced(batches))
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def sliced(batches):
    """The rows of ``batches`` in order, in slices of some SLICE_BYTES (a row at least)."""
    for b in batches:
        step = max(1, b.num_rows * SLICE_BYTES // max(SLICE_BYTES, b.nbytes))
        for at in range(0, max(b.num_rows, 1), step):
            yield b.slice(at, step)


def give_back() -> None:
    """Returns this process's unused memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def ship(spark) -> None:
    """Hand this package to the executors, once per application, as a zip in the shared folder."""
    sc = spark.sparkContext
    if sc in _SHIPPED:
        return
    top = Path(cairn.__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    path = scratch(spark, "llm") + "/cairn.zip"
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    out = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath)  # noqa: SLF001
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc)


def words(text: Column) -> Column:
    """Array of the words of a text (empty for a null or blank one)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (id, component) per node.

    ``component`` is the smallest id that can be reached. Each round hooks
    every node to its smallest neighbour, follows the hook once more, and
    keeps only the edges that still join different nodes; hubs are reduced by
    a map-side minimum. Nulls and loops in ``edges`` are ignored. The nodes
    and edges stay in tables; the driver only asks whether edges are left.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    nodes = stored(nodes.select("id", F.col("id").alias("component")), "nodes")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy("a").agg(F.min("b").alias("to"))
        hook = stored(hook.select("a", F.least("a", "to").alias("to")), "hook")
        jump = hook.select(F.col("a").alias("to"), F.col("to").alias("far"))
        hook = stored(hook.join(jump, "to", "left").select("a", F.coalesce("far", "to").alias("to")), "hook")
        nodes = stored(
            nodes.join(hook.withColumnRenamed("a", "component"), "component", "left")
            .select("id", F.coalesce("to", "component").alias("component")), "nodes")
        from_a = hook.withColumnRenamed("to", "ra")
        from_b = hook.select(F.col("a").alias("b"), F.col("to").alias("rb"))
        edges = stored(
            edges.join(from_a, "a").join(from_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return nodes
