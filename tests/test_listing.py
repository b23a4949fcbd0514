"""Listings by the executors."""

import os

import pytest

from cairn.sources.files import audit_empty_files
from cairn.sources.listing import list_tree


def test_tree_with_empty_hidden_and_odd_files(spark, tmp):
    base = tmp.split(":", 1)[-1]
    sizes = {"a.csv": 3, "b/c d.csv": 0, "b/é+%20/e.csv": 5, "b/é+%20/f/g.json": 0, "_temporary/h.csv": 1, "b/.i.csv": 2, "b/_SUCCESS": 0, "k=1/l.csv": 0}
    for name, n in sizes.items():
        os.makedirs(os.path.dirname(f"{base}/{name}"), exist_ok=True)
        with open(f"{base}/{name}", "w") as f:
            f.write("x" * n)
    os.makedirs(f"{base}/none/at/all")
    seen = {n: s for n, s in sizes.items() if not any(p.startswith(("_", ".")) for p in n.split("/"))}
    got = {r.path.split(base, 1)[1].lstrip("/"): r.length for r in list_tree(spark, tmp).collect()}
    assert got == seen
    assert {r.path.rsplit("/", 1)[1] for r in audit_empty_files(spark, tmp, glob="*.csv").collect()} == {"c d.csv", "l.csv"}
    assert list_tree(spark, f"{tmp}/none").count() == 0 and list_tree(spark, f"{tmp}/missing").count() == 0
    assert all(r.mtime is not None for r in list_tree(spark, tmp).collect())


def test_stores_that_executors_cannot_list_raise(spark, monkeypatch):
    monkeypatch.setattr("cairn.sources.listing.qualified", lambda spark, path: "viewfs://x/y")
    with pytest.raises(ValueError):
        list_tree(spark, "viewfs://x/y")
