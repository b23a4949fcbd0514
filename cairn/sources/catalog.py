"""Catalog: databases, external tables over file folders, partitions, crawl,
and a sink that keeps the catalog in step with what it wrote.

Tables are Spark native ``USING <format> … LOCATION`` tables: the catalog
never owns the data (dropping a table or partition leaves the files). Hive
SerDe tables are not used: Spark ignores their header-skip property.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cairn.sinks.files import write_frame

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    for p in parts:
        if not _IDENT.match(p):
            raise ValueError(f"bad identifier {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def _lit(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION {_lit(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)}{loc}")


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_external_table(spark: SparkSession, table: str, fmt: str, location: str,
                          schema: T.StructType | str | None = None,
                          partition_by: Sequence[str] | None = None,
                          options: dict | None = None, replace: bool = False) -> DataFrame:
    """``CREATE TABLE … USING fmt OPTIONS(…) PARTITIONED BY (…) LOCATION …``.

    With ``schema`` the columns are declared (partition columns included,
    as the last ones); without it Spark infers them from the files.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_ident(table)}")
    cols = ""
    if schema is not None:
        cols = f" ({schema if isinstance(schema, str) else schema_ddl(schema)})"
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"{_lit(k)} {_lit(v)}" for k, v in options.items()) + ")"
    parts = ""
    if partition_by:
        parts = " PARTITIONED BY (" + ", ".join(f"`{p}`" for p in partition_by) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(table)}{cols} USING {fmt}{opts}{parts} "
              f"LOCATION {_lit(location)}")
    return spark.table(table)


def repair_table(spark: SparkSession, table: str) -> None:
    """Discover partition folders written outside the catalog (MSCK REPAIR)."""
    spark.sql(f"MSCK REPAIR TABLE {_ident(table)}")


def _spec(values: dict) -> str:
    return ", ".join(f"`{k}` = " + ("NULL" if v is None else _lit(v)) for k, v in values.items())


def add_partitions(spark: SparkSession, table: str,
                   partitions: Sequence[tuple[dict, str | None]]) -> None:
    """``ALTER TABLE … ADD IF NOT EXISTS PARTITION (…) LOCATION …`` — targeted,
    unlike a repair that lists the whole folder."""
    clauses = []
    for values, loc in partitions:
        clauses.append(f"PARTITION ({_spec(values)})" + (f" LOCATION {_lit(loc)}" if loc else ""))
    spark.sql(f"ALTER TABLE {_ident(table)} ADD IF NOT EXISTS " + " ".join(clauses))


def drop_partition(spark: SparkSession, table: str, values: dict) -> None:
    """Remove a partition from the catalog; its files stay."""
    spark.sql(f"ALTER TABLE {_ident(table)} DROP IF EXISTS PARTITION ({_spec(values)})")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_ident(table)}")


def show_databases(spark: SparkSession, like: str = "*") -> DataFrame:
    """``SHOW DATABASES LIKE`` (namespace)."""
    return spark.sql(f"SHOW DATABASES LIKE {_lit(like)}")


def show_tables(spark: SparkSession, db: str, like: str = "*") -> DataFrame:
    """``SHOW TABLES IN … LIKE`` (namespace, tableName, isTemporary)."""
    return spark.sql(f"SHOW TABLES IN {_ident(db)} LIKE {_lit(like)}")


def show_create_table(spark: SparkSession, table: str) -> str:
    """The statement that makes the table again."""
    return spark.sql(f"SHOW CREATE TABLE {_ident(table)}").first()[0]


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """(column, type, partition): the table's columns, partition columns last and marked."""
    return spark.createDataFrame(
        [(c.name, c.dataType, bool(c.isPartition)) for c in spark.catalog.listColumns(table)],
        "column string, type string, partition boolean")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop an external table; the data folder is kept."""
    spark.sql(f"DROP TABLE IF EXISTS {_ident(table)}")


def refresh(spark: SparkSession, table: str) -> None:
    """Forget cached file listings (new files under the location become visible)."""
    spark.catalog.refreshTable(table)


# File suffix → format, for crawling.
SUFFIX_FORMATS = {
    ".csv": "csv", ".csv.gz": "csv", ".tsv": "csv", ".json": "json", ".jsonl": "json",
    ".json.gz": "json", ".parquet": "parquet", ".snappy.parquet": "parquet", ".orc": "orc",
    ".snappy.orc": "orc",
}


def detect_format(spark: SparkSession, path: str) -> str:
    """Format of a folder from its files' suffixes (the most common one)."""
    from cairn.sources.files import list_files
    from pyspark.sql import functions as F
    names = (list_files(spark, path).select(F.lower(F.regexp_extract("path", r"([^/]+)$", 1)).alias("n"))
             .filter(~F.col("n").startswith("_") & ~F.col("n").startswith(".")))
    fmt_col = None
    for suffix in sorted(SUFFIX_FORMATS, key=len, reverse=True):
        cond = F.col("n").endswith(suffix)
        fmt_col = (F.when(cond, SUFFIX_FORMATS[suffix]) if fmt_col is None
                   else fmt_col.when(cond, SUFFIX_FORMATS[suffix]))
    row = (names.select(fmt_col.alias("fmt")).filter("fmt IS NOT NULL")
           .groupBy("fmt").count().orderBy(F.desc("count"), "fmt").first())
    if row is None:
        raise ValueError(f"no recognised data files under {path}")
    return row.fmt


def crawl(spark: SparkSession, table: str, path: str, csv_options: dict | None = None) -> dict:
    """Crawler: infer format, columns, types and partitions of a folder, then
    create the table — or re-create it when the inferred schema changed. The
    partitions are discovered on every crawl; the action is ``updated`` when
    the schema or the set of partitions changed. Returns ``{"format", "action", "partitions"}``."""
    fmt = detect_format(spark, path)
    r = spark.read.format(fmt)
    opts = {}
    if fmt == "csv":
        opts = {"header": "true", "inferSchema": "true", **(csv_options or {})}
    elif fmt in ("parquet", "orc"):
        r = r.option("mergeSchema", "true")  # columns added by later files
    for k, v in opts.items():
        r = r.option(k, v)
    sample = r.load(path)
    inferred = sample.schema
    part_cols = _partition_columns(spark, path)
    action = "created"
    if spark.catalog.tableExists(table):
        if spark.table(table).schema.simpleString() == inferred.simpleString():
            if part_cols:
                before = show_partitions(spark, table).count()
                repair_table(spark, table)
                if show_partitions(spark, table).count() != before:
                    action = "updated"
            refresh(spark, table)
            return {"format": fmt, "action": "unchanged" if action == "created" else action,
                    "partitions": part_cols}
        action = "updated"
        drop_table(spark, table)
    create_external_table(spark, table, fmt, path, schema=inferred,
                          partition_by=part_cols or None,
                          options={k: v for k, v in opts.items() if k != "inferSchema"} or None)
    if part_cols:
        repair_table(spark, table)
    return {"format": fmt, "action": action, "partitions": part_cols}


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a folder; every file must sit below the same ones."""
    from cairn.sources.files import list_files
    from pyspark.sql import functions as F
    base = path.rstrip("/").split("://")[-1]
    tail = F.expr(f"substring(path, locate({_lit(base)}, path) + {len(base)})")
    folders = F.split(F.regexp_replace(tail, "/[^/]*$", ""), "/")
    keys = F.transform(F.filter(folders, lambda f: f.contains("=")),
                       lambda f: F.substring_index(f, "=", 1))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    layouts = (list_files(spark, path).filter(~name.startswith("_") & ~name.startswith("."))
               .select(keys.alias("k")).distinct().limit(2).collect())  # one row when consistent
    if len(layouts) > 1:
        raise ValueError(f"files under {path} have different partition columns: "
                         f"{sorted(r.k for r in layouts)}")
    return list(layouts[0].k) if layouts else []


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a catalog table, without scheme and host."""
    row = (spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(table)}")
           .filter("col_name = 'Location'").select("data_type").first())
    return _bare(spark, row.data_type)


def _bare(spark: SparkSession, path: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()  # noqa: SLF001


def _new_columns(spark: SparkSession, table: str, df: DataFrame, path: str, fmt: str,
                 partition_by: Sequence[str]) -> list[T.StructField]:
    """Columns of ``df`` that the table lacks; raises, before anything is
    written, on a change that would hide or misread rows already there."""
    if table_location(spark, table) != _bare(spark, path):
        raise ValueError(f"{table} lies at {table_location(spark, table)}, not at {path}")
    current = spark.table(table).schema
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != list(partition_by):
        raise ValueError(f"{table} is partitioned by {parts}, not by {list(partition_by)}")
    have = {f.name: f.dataType for f in current.fields}
    for f in df.schema.fields:
        if f.name in have and have[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(f"{table}.{f.name} is {have[f.name].simpleString()}, "
                             f"not {f.dataType.simpleString()}")
    if fmt == "csv" and [c for c in current.names if c not in parts] != \
            [c for c in df.columns if c not in parts]:
        raise ValueError(f"CSV binds by position: the columns of {table} cannot change")
    return [f for f in df.schema.fields if f.name not in have]


def catalog_sink(df: DataFrame, table: str, path: str, fmt: str = "parquet",
                 partition_by: Sequence[str] | None = None, compression: str = "snappy",
                 update_behavior: str = "UPDATE_IN_DATABASE") -> DataFrame:
    """Write a frame and keep the catalog table in step (``getSink`` with
    ``enableUpdateCatalog``): the table is created on first write; later
    writes append, add the partitions just written (no full-folder listing)
    and, with ``UPDATE_IN_DATABASE``, add new columns to the table. Columns
    missing from a later frame read as NULL there. Another folder, other
    partition columns or a changed type raise before anything is written.

    The written partition values are an observed metric of the write job
    itself (``observe`` + ``collect_set``, merged across tasks; one entry per
    partition), so the input is computed once, not again for a ``distinct``.
    They are kept as the text the writer names folders with; the empty text
    and NULL both go to Spark's default partition."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    spark = df.sparkSession
    partition_by = list(partition_by or [])
    exists = spark.catalog.tableExists(table)
    added = _new_columns(spark, table, df, path, fmt, partition_by) if exists else []
    obs = None
    if partition_by:
        obs = Observation(f"written_{table}")
        values = [F.nullif(F.col(f"`{p}`").cast("string"), F.lit("")).alias(p) for p in partition_by]
        df = df.observe(obs, F.collect_set(F.struct(*values)).alias("parts"))
    write_frame(df, path, fmt, mode="append", partition_by=partition_by or None,
                compression=compression, dynamic=False)
    if not exists:
        data_cols = [f for f in df.schema.fields if f.name not in partition_by]
        part_fields = [df.schema[p] for p in partition_by]
        create_external_table(spark, table, fmt, path, schema=T.StructType(data_cols + part_fields),
                              partition_by=partition_by or None,
                              options={"header": "true"} if fmt == "csv" else None)
    elif added and update_behavior == "UPDATE_IN_DATABASE":
        spark.sql(f"ALTER TABLE {_ident(table)} ADD COLUMNS ({schema_ddl(T.StructType(added))})")
    if partition_by and obs.get["parts"]:
        # no LOCATION: Spark derives the escaped folder names itself
        add_partitions(spark, table, [({p: r[p] for p in partition_by}, None) for r in obs.get["parts"]])
    refresh(spark, table)
    return spark.table(table)
