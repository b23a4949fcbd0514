"""Every registered query of the core against its DuckDB SQL on the small tables
(row count, column names, order-insensitive values); queries without SQL
must at least run."""

import duckdb
import pytest

import __spark_entry__ as E
from cairn.plans import registry
from cairn.session import TABLES, table_path
from tools.oracle_check import rows_of

from conftest import SF_SMALL

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield con
    con.close()


def test_every_query_has_sql_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"map_partitions_index", "audit_empty_files", "bookmark_state"}
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "total_revenue", "total_orders"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = df.collect()
    if name not in ORACLE:
        return
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert rows_of(df.columns, got, True) == rows_of(cols, want, True)
