"""Jobs from source to sink: one scan of each fact, outputs that appear
together, and rows that appear with the record of the files they came from."""

import pytest
from pyspark.sql import functions as F

from cairn.incremental import bookmark
from cairn.incremental.bookmark import Bookmark
from cairn.plans import jobs
from cairn.sinks import publish as P
from cairn.sinks.files import write_frame

from conftest import SF_SMALL


def scans(df):
    """Files scanned by the executed plan, in order of mention."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Location:")[1].split("]")[0] for line in plan.splitlines() if "Location:" in line and "FileScan" in line]


@pytest.mark.parametrize("groups, facts", [(jobs.order_groups, ("lineitem", "orders", "part")), (jobs.flight_groups, ("orders", "customer"))])
def test_one_scan_of_each_fact(spark, groups, facts):
    found = scans(groups(spark, SF_SMALL))
    assert {t: sum(f"{t}.parquet" in x for x in found) for t in facts} == dict.fromkeys(facts, 1)


def test_outputs_are_published_together_or_not_at_all(spark, tmp):
    root = f"{tmp}/pub"
    with pytest.raises(FileNotFoundError):
        P.published(spark, root, "a")
    one = {"a": spark.range(3), "b": spark.range(5)}
    P.publish(spark, root, one)
    read = lambda n: spark.read.option("header", True).csv(P.published(spark, root, n)).count()
    assert (read("a"), read("b")) == (3, 5)
    bad = spark.range(1).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        P.publish(spark, root, {"a": spark.range(9), "b": bad})
    assert (read("a"), read("b")) == (3, 5)
    P.publish(spark, root, {"a": spark.range(7), "b": spark.range(8)})
    assert (read("a"), read("b")) == (7, 8)


@pytest.fixture()
def job(spark, tmp):
    src, target = f"{tmp}/source", f"{tmp}/target"

    def put(lo, hi):
        write_frame(spark.range(lo, hi), f"{src}/{lo}", "parquet")

    def run():
        bm = Bookmark(spark, f"{tmp}/state", "load")
        bm.append(bm.read_new(src, "parquet", "id bigint", glob="*.parquet"), target)

    def rows():
        return sorted(r.id for r in spark.read.parquet(target).collect())

    return put, run, rows


class Crash(Exception):
    pass


def crash(*a):
    raise Crash


# before the record; after it; between the two renames that it names
@pytest.mark.parametrize("where", ["record", "finish", "second rename"])
def test_a_crash_neither_repeats_nor_loses_rows(job, monkeypatch, where):
    put, run, rows = job
    put(0, 10)
    run()
    put(10, 25)
    with monkeypatch.context() as m:
        if where == "second rename":
            real, done = P.rename, []

            def once(*a):
                if done:
                    raise Crash
                done.append(a)
                real(*a)

            m.setattr(P, "rename", once)
        else:
            m.setattr(P.Commit, where, crash)
        with pytest.raises(Crash):
            run()
    put(25, 30)
    run()
    assert rows() == list(range(30))
    run()
    assert rows() == list(range(30))


def test_files_that_arrive_after_the_listing_wait(spark, tmp, monkeypatch):
    src = f"{tmp}/source"
    write_frame(spark.range(5), f"{src}/a", "parquet")
    bm = Bookmark(spark, f"{tmp}/state", "load")
    real = bookmark._with_file

    def late(df):
        # a file lands between the listing and the scan, within the scan's times
        write_frame(spark.range(5, 8), f"{src}/b", "parquet")
        return real(spark.read.schema("id bigint").option("recursiveFileLookup", True).parquet(src))

    monkeypatch.setattr(bookmark, "_with_file", late)
    first = bm.read_new(src, "parquet", "id bigint", glob="*.parquet")
    assert sorted(r.id for r in first.collect()) == list(range(5))
    bm.commit()
    monkeypatch.setattr(bookmark, "_with_file", real)
    second = Bookmark(spark, f"{tmp}/state", "load").read_new(src, "parquet", "id bigint", glob="*.parquet")
    assert sorted(r.id for r in second.collect()) == [5, 6, 7]


def test_odd_file_names_and_a_state_with_many_runs(spark, tmp):
    src = f"{tmp}/source dir"
    for n in ("a b", "c%20d", "é+ü"):
        write_frame(spark.range(2), f"{src}/{n}", "parquet")
    for want in (6, 0, 0):
        bm = Bookmark(spark, f"{tmp}/state", "load")
        assert bm.read_new(src, "parquet", "id bigint", glob="*.parquet").count() == want
        bm.commit()
    files = Bookmark(spark, f"{tmp}/state", "load").state()
    assert files.count() == files.select("path").distinct().count()
