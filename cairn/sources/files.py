"""File sources: CSV (all-text, inferred, explicit schema, malformed-row
modes, gzip, custom separators/quotes), JSON lines, Parquet, ORC, a generic
format/options builder, file listings and JDBC.

Every reader returns a lazy DataFrame: column pruning and filters reach the
scan (``ReadSchema`` / ``PushedFilters`` in ``explain``) for the columnar
formats. Listings use the ``binaryFile`` source without selecting
``content``, so no file body is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.sources.listing import list_tree


def read_csv(spark: SparkSession, path: str | list[str], header: bool = True,
             infer: bool = False, schema: T.StructType | str | None = None,
             sep: str = ",", quote: str = '"', escape: str | None = None,
             mode: str = "PERMISSIVE", corrupt_column: str | None = None,
             recurse: bool = False, glob: str | None = None,
             multiline: bool = False, **options) -> DataFrame:
    """CSV scan. Without ``schema`` and ``infer`` every column is text.

    ``mode``: PERMISSIVE (bad fields → NULL, whole line kept in
    ``corrupt_column`` when given), DROPMALFORMED (bad rows dropped) or
    FAILFAST (first bad row raises). ``.csv.gz`` files decompress by suffix.
    Spark parses only the columns a query reads, so a bad value in a column
    that is not selected does not make a row malformed.
    """
    r = (spark.read.option("header", header).option("sep", sep).option("quote", quote)
         .option("mode", mode).option("multiLine", multiline))
    if escape is not None:
        r = r.option("escape", escape)
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if recurse:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_json(spark: SparkSession, path: str | list[str],
              schema: T.StructType | str | None = None, multiline: bool = False,
              mode: str = "PERMISSIVE", **options) -> DataFrame:
    r = spark.read.option("multiLine", multiline).option("mode", mode)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, path: str | list[str], merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(
        *(path if isinstance(path, list) else [path]))


def read_orc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.orc(path)


class Source:
    """Generic source builder: ``Source(spark).format("csv", header=True).frame(path)``."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._fmt = "parquet"
        self._opts: dict = {}
        self._schema = None

    def format(self, fmt: str, **options) -> "Source":
        self._fmt = fmt
        self._opts.update(options)
        return self

    def options(self, **options) -> "Source":
        self._opts.update(options)
        return self

    def schema(self, schema) -> "Source":
        self._schema = schema
        return self

    def frame(self, path: str | list[str] | None = None) -> DataFrame:
        r = self._spark.read.format(self._fmt)
        for k, v in self._opts.items():
            r = r.option(k, v)
        if self._schema is not None:
            r = r.schema(self._schema)
        return r.load(path) if path is not None else r.load()


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recurse: bool = True) -> DataFrame:
    """(path, modificationTime, length) of the files under ``path``; only
    metadata is read (``content`` is never selected, so it is pruned)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recurse:
        r = r.option("recursiveFileLookup", True)
    return r.load(path).select("path", "modificationTime", "length")


def audit_empty_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files of size 0 under a prefix (re-aimed from an empty-input alert).

    File sources skip zero-length files (they yield no splits), so the tree is
    listed by the executors (``sources.listing``).
    """
    return list_tree(spark, path, glob).where("length = 0").select("path", "length")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    """JDBC scan; with a partition column the read is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file path and modification time each row came from
    (file-source hidden ``_metadata`` column)."""
    return df.select("*", F.col("_metadata.file_path").alias("source_path"),
                     F.col("_metadata.file_modification_time").alias("source_mtime"))


def group_files(spark: SparkSession, max_partition_bytes: int | None = None,
                open_cost_bytes: int | None = None) -> None:
    """File grouping for scans (``groupFiles`` / ``groupSize``): Spark packs
    small files into one read task up to ``max_partition_bytes``, counting
    ``open_cost_bytes`` per file; set a small open cost to spread many tiny
    files over more tasks, a large one to group them."""
    if max_partition_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
    if open_cost_bytes is not None:
        spark.conf.set("spark.sql.files.openCostInBytes", str(open_cost_bytes))
