"""Outputs that appear together: staged writes, one rename, a commit record.

A write of several tasks, and more so a write of several outputs, has a time
in which part of it is there. Here everything is written below a hidden folder
first (readers skip names that begin with ``_``) and appears by the rename of
one folder, which file systems do as one step.

* ``publish``: several outputs as one version of a folder, named by a pointer
  that is replaced last; readers see the old version or the new one.
* ``Commit``: renames that belong together (a batch of rows and the bookmark
  of the files it came from). A record names them before the first is done;
  whoever comes next carries an unfinished record through. Each rename is done
  once, whether or not it was done before a crash.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cairn.session import path_exists
from cairn.sinks.files import write_frame

_POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API, metadata only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def rename(spark: SparkSession, src: str, dest: str) -> None:
    """Move a folder to a place that must not exist; its parent is made."""
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dest)
    fs.mkdirs(d.getParent())
    if fs.exists(d) or not fs.rename(s, d):
        raise RuntimeError(f"cannot move {src} to {dest}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all (written aside, renamed)."""
    aside = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex[:12]}"
    fs, p = _fs(spark, aside)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, d = _fs(spark, path)
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(  # noqa: SLF001
        p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    kind = getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename")  # noqa: SLF001
    options = spark.sparkContext._gateway.new_array(kind, 1)  # noqa: SLF001
    options[0] = kind.OVERWRITE
    context.rename(p, d, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, outputs: Mapping[str, DataFrame], fmt: str = "csv", **options) -> str:
    """Write every output below ``root`` as one version and make it the current one.

    If any write fails, no reader sees any of them: the version before stays
    current. Returns the version's folder. Versions stay; remove old ones when
    no reader is left.
    """
    name = uuid.uuid4().hex[:12]
    staged = f"{root}/_staged-{name}"
    for output, df in outputs.items():
        write_frame(df, f"{staged}/{output}", fmt, **options)
    rename(spark, staged, f"{root}/version-{name}")
    write_text(spark, f"{root}/{_POINTER}", name)
    return f"{root}/version-{name}"


def published(spark: SparkSession, root: str, output: str) -> str:
    """Folder of an output in the current version."""
    name = read_text(spark, f"{root}/{_POINTER}")
    if name is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    return f"{root}/version-{name}/{output}"


class Commit:
    """Folders that appear together: ``moves`` of (staged, final), under a record.

    ``record`` is the point of no return: before it, nothing is committed and
    the staged folders are left-overs; after it, ``finish`` (here or in
    ``recover``) does what is left to do.
    """

    def __init__(self, spark: SparkSession, log: str, name: str, moves: list[tuple[str, str]]):
        self.spark, self.path, self.moves = spark, f"{log}/{name}.json", moves

    def record(self) -> None:
        fs, p = _fs(self.spark, self.path)
        fs.mkdirs(p.getParent())
        write_text(self.spark, self.path, json.dumps(self.moves))

    def finish(self) -> None:
        for staged, final in self.moves:
            if path_exists(self.spark, staged):
                rename(self.spark, staged, final)
            elif not path_exists(self.spark, final):
                raise RuntimeError(f"{self.path}: neither {staged} nor {final} is there")
        fs, p = _fs(self.spark, self.path)
        fs.delete(p, False)


def recover(spark: SparkSession, log: str) -> int:
    """Carry every recorded commit through; returns how many there were."""
    fs, p = _fs(spark, log)
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    names = sorted(n for n in names if n.endswith(".json") and not n.startswith("_"))
    for n in names:
        moves = [tuple(m) for m in json.loads(read_text(spark, f"{log}/{n}"))]
        Commit(spark, log, n.removesuffix(".json"), moves).finish()
    return len(names)
