"""Sinks: CSV/Parquet/ORC/JSON writes, append, partitioned and dynamic
partition overwrite, catalog inserts, format conversion, date-foldered
landing and JDBC.

Writers never overwrite their own input (Spark refuses it); an upsert
result goes to a new folder. Parallelism is the frame's own: a single file is
only written for results whose size was checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.dates import date_folders
from cairn.session import scratch


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, compression: str | None = None,
                header: bool = True, dynamic: bool = False, max_records_per_file: int | None = None,
                rebalance: bool = True, **options) -> str:
    """Write ``df`` to ``path``. ``dynamic=True`` with ``mode='overwrite'`` only
    replaces the partitions present in ``df`` (other partitions stay).

    A partitioned write is rebalanced on the partition columns first (the
    ``REBALANCE`` hint): each output folder is written by few tasks instead of
    every task writing a small file into every folder, and AQE splits a hot
    partition value into several tasks rather than one."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.option("header", header)
    # said outright: a session default must not keep partitions of an overwrite
    w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", max_bytes: int = 1 << 30, **kw) -> str:
    """One output file, for results whose size is proven: the result is written
    in parallel first (Parquet, below the shared scratch folder), and one task
    copies it only if that is at most ``max_bytes``; else this raises."""
    spark = df.sparkSession
    staged = scratch(spark, "single-file")
    df.write.parquet(staged)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)  # noqa: SLF001 - metadata only
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()  # noqa: SLF001
    if size > max_bytes:
        raise ValueError(f"a result of {size} bytes is too large for one file (at most {max_bytes})")
    # in the order of the frame: its partitions' files, and their rows
    rows = spark.read.schema(df.schema).parquet(staged)
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    rows = rows.coalesce(1).sortWithinPartitions("__file", "__row").drop("__file", "__row")
    return write_frame(rows, path, fmt, **kw)


def convert_format(spark: SparkSession, src: str, src_fmt: str, dest: str,
                   dest_fmt: str = "parquet", read_options: dict | None = None,
                   partition_by: Sequence[str] | None = None) -> str:
    """Row format (CSV/JSON) → columnar (Parquet/ORC): one read, one write."""
    r = spark.read.format(src_fmt)
    for k, v in (read_options or {}).items():
        r = r.option(k, v)
    return write_frame(r.load(src), dest, dest_fmt, partition_by=partition_by)


def insert_into_table(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert into a catalog table by the table's declared column order."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=overwrite)


def land_by_date(spark: SparkSession, src: str, dest: str, fmt: str = "csv",
                 glob: str | None = None, ts_col: str | None = None,
                 read_options: dict | None = None, out_fmt: str = "csv",
                 bookmark=None) -> str:
    """Files under ``src`` land under ``dest/prefix=…/year=YYYY/month=MM/day=DD/``.

    The date is the record's ``ts_col`` when given, else the file's
    modification time (its arrival). ``prefix`` is the file's parent folder
    name (``raw/orders/orders.csv`` → ``orders``). Without ``bookmark`` every
    file under ``src`` is landed (appended) on each call; with an enabled
    ``incremental.bookmark.Bookmark`` only files it has not committed are
    read, and the bookmark is committed after the write, so repeated runs
    land each file once.
    """
    r = spark.read.format(fmt).option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    opts = {"header": True} if fmt == "csv" else {}
    opts.update(read_options or {})
    for k, v in opts.items():
        r = r.option(k, v)
    if bookmark is not None:
        # scanned with the folder's own layout; only rows of unseen files remain
        df = bookmark.scan_new(r, src, glob)
    else:
        df = r.load(src).select("*", F.struct(F.col("_metadata.file_path").alias("path"),
                                              F.col("_metadata.file_modification_time").alias("mtime")).alias("_file"))
    when = F.col(ts_col) if ts_col else F.col("_file.mtime")
    landed = df.select("*",
                       F.regexp_extract("_file.path", r"([^/]+)/[^/]+$", 1).alias("prefix"),
                       *date_folders(when)).drop("_file")
    write_frame(landed, dest, out_fmt, mode="append",
                partition_by=["prefix", "year", "month", "day"])
    if bookmark is not None:
        bookmark.commit()
    return dest


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10000,
               num_partitions: int | None = None) -> None:
    """JDBC sink; ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
