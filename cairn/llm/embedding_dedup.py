"""Near-duplicate vectors with a forest of random-projection trees.

Each tree splits a label's vectors recursively at the median of a random
direction; vectors within a margin of a split spill to both sides. Vectors
that share a leaf in any tree are compared exactly. A pair that meets in
several leaves is counted in the first of them only, and a leaf returns counts
per vector and the links of its local components' stars, never its pairs.

Splits would part most pairs of a large tight group, so dense places are taken
out first: around a pivot, a sampled vector with many near ones, the vectors
near the pivot (the core of a cell) are compared in blocks with all that may
be near one of them, which are those within twice the angle of the pivot. So
all links of a core vector are found, and the trees hold the other vectors.

Directions belong to a level of a tree. Split points come from a bounded
sample per label; below the nodes that the sample resolves, a node goes on
with the split points of its nearest resolved ancestor, so trees get as deep
as the number of vectors asks for while the model keeps its size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import components, map_arrow, ship, stored
from cairn.llm.registry import query
from cairn.session import load

COSINE = 0.93
TREES = 12
#: Vectors aimed at per leaf, and rows of a leaf compared at once.
LEAF, BLOCK = 512, 1024
#: Share of a node's vectors on either side of a split that spill over.
SPILL = 0.09
#: Vectors of the sample that fits the split points, over all labels, and the
#: fewest sampled vectors that a node needs for a split of its own.
SAMPLE, RESOLVED = 20_000, 64
#: Leaves that the vectors near a pivot would fill at least, as the sample has
#: it; the fewest sampled vectors that tell so; rows of a cell compared at once.
DENSE, TOLD, CELL = 2, 4, 2048


def _direction(tree: int, level: int, width: int) -> np.ndarray:
    return np.random.default_rng([7, tree, level]).standard_normal(width)


def _fit(sample: np.ndarray, depth: int, trees: int) -> list[dict[str, tuple]]:
    """Per tree: node path ('' is the root) to (low, mid, high) by level below it.

    A resolved node has its own split first; the points of deeper levels serve
    its descendants that are not resolved.
    """
    out = []
    for tree in range(trees):
        p = np.stack([sample @ _direction(tree, level, sample.shape[1]) for level in range(depth)], 1) if depth else None
        nodes, todo = {}, [("", np.arange(len(sample)))]
        while todo and depth:
            path, own = todo.pop()
            if path and len(own) < RESOLVED:
                continue
            nodes[path] = tuple(map(tuple, np.quantile(p[own, len(path):], [0.5 - SPILL, 0.5, 0.5 + SPILL], axis=0).T))
            if len(path) + 1 < depth:
                mid = nodes[path][0][1]
                side = p[own, len(path)] > mid
                todo += [(path + "0", own[~side]), (path + "1", own[side])]
        out.append(nodes)
    return out


def _leaves(v: np.ndarray, depth: int, trees: list[dict[str, tuple]]) -> list[list[int]]:
    """Leaf numbers of each row of ``v``, ascending by tree."""
    found: list[list[int]] = [[] for _ in v]
    for tree, nodes in enumerate(trees):
        p = [v @ _direction(tree, level, v.shape[1]) for level in range(depth)]
        todo = [("", "", np.arange(len(v)))]
        while todo:
            path, known, own = todo.pop()
            level = len(path)
            if level == depth:
                # a leaf's number: the tree above a digest of its path
                number = tree << 56 | int.from_bytes(hashlib.blake2b(path.encode(), digest_size=7).digest(), "big")
                for i in own:
                    found[i].append(number)
                continue
            known = path if path in nodes else known
            low, _, high = nodes[known][level - len(known)]
            x = p[level][own]
            if len(left := own[x <= high]):
                todo.append((path + "0", known, left))
            if len(right := own[x >= low]):
                todo.append((path + "1", known, right))
    return [sorted(x) for x in found]


def _unit(vectors) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    v = np.asarray(vectors, dtype=np.float64)
    with np.errstate(over="ignore"):
        top = np.abs(v).max(axis=1, keepdims=True)
    v = v / top
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _pivots(sample: np.ndarray, cosine: float, least: int) -> np.ndarray:
    """Sampled vectors with ``least`` or more near ones that are near no earlier pivot."""
    def near(own):
        found = np.zeros(len(sample), np.int64)
        for at in range(0, len(own), 256):
            found += np.count_nonzero(sample @ own[at:at + 256].T >= cosine, axis=1)
        return found

    count, free, picked = near(sample), np.ones(len(sample), bool), []
    while len(sample) and count.max() >= least:
        top = int(count.argmax())
        own = free & (sample @ sample[top] >= cosine)
        picked.append(top)
        count -= near(sample[own])
        count[top] = 0
        free &= ~own
    return sample[picked]


def _cells(v: np.ndarray, pivots: np.ndarray, cosine: float) -> tuple[np.ndarray, list[list[int]]]:
    """The cell whose core holds a row, or -1, and the cells that it is compared in."""
    s = v @ pivots.T
    home = np.where(s.max(axis=1) >= cosine, s.argmax(axis=1), -1)
    # angles add up: what is near a core vector is within twice the angle
    wide = 2 * cosine * cosine - 1 - 1e-9 if cosine > 0 else -2
    return home, [np.flatnonzero(x).tolist() for x in s >= wide]


def _links_in_cell(table: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links counted here, smallest linked id of its local component)."""
    ids, n, home = (table.column(c).to_numpy() for c in ("id", "n", "home"))
    left = table.column("left").to_numpy(zero_copy_only=False)
    own, other = np.flatnonzero(left), np.flatnonzero(~left)
    if not len(own) or not len(other):
        return (np.empty(0, np.int64),) * 3
    v = _unit(np.stack([np.frombuffer(x, np.float64) for x in table.column("v").to_pylist()]))
    hits = (v[own] @ v[other].T >= cosine) & (ids[own][:, None] != ids[other])
    a, b, none = ids[own], ids[other], np.iinfo(np.int64).max
    while True:
        low = np.minimum(a, np.where(hits, b, none).min(axis=1))
        back = np.minimum(b, np.where(hits, low[:, None], none).min(axis=0))
        if (low == a).all() and (back == b).all():
            break
        a, b = low, back
    # a core vector counts its links in its own cell, and those of the others there
    weight = hits.astype(np.float64)
    count = np.concatenate([weight @ n[other], np.where(home[other] < 0, n[own] @ weight, 0)]).astype(np.int64)
    hit = np.concatenate([hits.any(axis=1), hits.any(axis=0)])
    return np.concatenate([ids[own], ids[other]])[hit], count[hit], np.concatenate([a, b])[hit]


def _links_in_block(table: pa.Table, cosine: float) -> tuple[list, list, list]:
    """(id, links counted here, smallest linked id of its local component)."""
    ids, i, weight = (table.column(c).to_numpy() for c in ("id", "i", "n"))
    lo, hi, leaf = (table.column(c)[0].as_py() for c in ("lo", "hi", "leaf"))
    v = _unit(np.stack([np.frombuffer(x, np.float64) for x in table.column("v").to_pylist()]))
    lists = table.column("leaves").to_pylist()
    width = max(map(len, lists))
    leaves = np.full((len(lists), width), -1, np.int64)
    for r, x in enumerate(lists):
        leaves[r, :len(x)] = x
    count, component = np.zeros(len(ids), np.int64), np.arange(len(ids))
    left, right = np.flatnonzero(i == lo), np.flatnonzero(i == hi)
    pairs = []
    for at in range(0, len(left), 256):
        rows = left[at:at + 256]
        a, b = np.nonzero(v[rows] @ v[right].T >= cosine)
        a, b = rows[a], right[b]
        keep = ids[a] < ids[b] if lo == hi else np.ones(len(a), bool)
        pairs.append(np.stack([a[keep], b[keep]]))
    a, b = np.concatenate(pairs, axis=1)
    # local components: each row takes the smallest number of its neighbours
    while len(a):
        before = component.copy()
        low = np.minimum(component[a], component[b])
        np.minimum.at(component, a, low)
        np.minimum.at(component, b, low)
        component = component[component]
        if (before == component).all():
            break
    for at in range(0, len(a), 20_000):
        x, y = a[at:at + 20_000], b[at:at + 20_000]
        # the pair counts in the first leaf that it shares, which is this one if none before is
        earlier = np.zeros(len(x), bool)
        for k in range(width):
            own = leaves[x, k]
            earlier |= (own >= 0) & (own < leaf) & (leaves[y] == own[:, None]).any(axis=1)
        np.add.at(count, x[~earlier], weight[y[~earlier]])
        np.add.at(count, y[~earlier], weight[x[~earlier]])
    hit = np.zeros(len(ids), bool)
    hit[a] = hit[b] = True
    return ids[hit].tolist(), count[hit].tolist(), ids[component[hit]].tolist()


def _dense(settled: DataFrame, cosine: float) -> DataFrame:
    """Rows (id, links, low) of the links that core vectors have.

    A cell's core and all its vectors are dealt into blocks; a task compares
    one block of each.
    """
    rows = settled.withColumn("cell", F.explode("cells")).drop("cells")
    blocks = lambda c: F.greatest(F.ceil(c / CELL), F.lit(1)).cast("int")
    size = rows.groupBy("label", "width", "cell").agg(blocks(F.count(F.when(F.col("home") == F.col("cell"), 1))).alias("k"), blocks(F.count(F.lit(1))).alias("m"))
    rows = rows.join(size, ["label", "width", "cell"])
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("j", deal("m")).withColumn("left", F.lit(False))
    core = rows.where("home = cell").withColumn("i", deal("k")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumn("left", F.lit(True))

    def to_bytes(batches):
        for b in batches:
            v = pa.array([np.array(x, np.float64).tobytes() for x in b.column("v").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([v if c == "v" else b.column(c) for c in b.schema.names], b.schema.names)

    def compare(table):
        ids, count, low = _links_in_cell(table, cosine)
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(count, pa.int64()), "low": pa.array(low, pa.int64())})

    both = every.unionByName(core).select("label", "width", "cell", "i", "j", "left", "id", "n", "home", "v")
    kind = settled.schema["label"].dataType.simpleString()
    both = map_arrow(both, to_bytes, f"label {kind}, width int, cell int, i int, j int, left boolean, id long, n long, home int, v binary")
    return both.groupBy("label", "width", "cell", "i", "j").applyInArrow(compare, "id long, links long, low long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Cases: a null label, and a null or empty vector, one of zeros, or one with
    null, NaN or infinite components link with nothing; equal vectors of a
    label collapse before the search, so copies cost nothing; vectors of
    different widths do not link; rows that repeat a vec_id each count as a
    vector but share a component; a null vec_id stands alone (component null,
    kept false); an empty table gives no rows; other columns are not read.
    """
    every = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    good = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    real = every.where(good)
    groups = real.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.select("label", "v", F.size("v").alias("width"), "id", "n"), "vectors")
    # the sample: the vectors with the smallest hashes, at most SAMPLE
    picked = groups.select("label", "width", "v").orderBy(F.xxhash64("v"), "label").limit(SAMPLE)
    by_label: dict = {}
    for r in picked.toLocalIterator():
        by_label.setdefault((r["label"], r["width"]), []).append(r["v"])
    by_label = {key: _unit(sampled) for key, sampled in by_label.items()}
    share = min(1.0, SAMPLE / max(groups.count(), 1))
    pivots = {key: p for key, sample in by_label.items() if len(p := _pivots(sample, cosine, max(TOLD, int(np.ceil(DENSE * LEAF * share)))))}

    def settle(batches):
        for b in batches:
            labels, widths = b.column("label").to_pylist(), b.column("width").to_pylist()
            v = b.column("v").to_pylist()
            rows: dict = {}
            for r, key in enumerate(zip(labels, widths, strict=True)):
                rows.setdefault(key, []).append(r)
            home, cells = np.full(len(v), -1, np.int32), [[] for _ in v]
            for key, own in rows.items():
                if key in pivots:
                    home[own], found = _cells(_unit([v[r] for r in own]), pivots[key], cosine)
                    for r, x in zip(own, found, strict=True):
                        cells[r] = x
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("label", "width", "id", "n", "v")), pa.array(home), pa.array(cells, pa.list_(pa.int32()))],
                                             ["label", "width", "id", "n", "v", "home", "cells"])

    label_type = groups.schema["label"].dataType.simpleString()
    if pivots:
        settled = stored(map_arrow(groups.select("label", "width", "id", "n", "v"), settle,
                                   f"label {label_type}, width int, id long, n long, v array<double>, home int, cells array<int>"), "cells")
        rest = settled.where("home < 0").select("label", "width", "id", "n", "v")
    else:
        rest = groups.select("label", "width", "id", "n", "v")
    top = rest.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    depth_of = lambda n: max(0, int(np.ceil(np.log2(max(n, 1) / LEAF))))
    fitted = {}
    for key, sample in by_label.items():
        loose = sample[_cells(sample, pivots[key], cosine)[0] < 0] if key in pivots else sample
        if len(loose):
            fitted[key] = _fit(loose, depth_of(top), trees)
    depth = depth_of(top)

    def assign(batches):
        for b in batches:
            labels, widths = b.column("label").to_pylist(), b.column("width").to_pylist()
            v = b.column("v").to_pylist()
            rows: dict = {}
            for r, key in enumerate(zip(labels, widths, strict=True)):
                rows.setdefault(key, []).append(r)
            out: list = [None] * len(v)
            for key, own in rows.items():
                # a label that the sample lacks is small, or a single leaf
                model = fitted.get(key)
                found = _leaves(_unit([v[r] for r in own]), depth, model) if model and depth else [[0]] * len(own)
                for r, x in zip(own, found, strict=True):
                    out[r] = x
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), b.column("width"), b.column("id"), b.column("n"),
                 pa.array([np.array(x, np.float64).tobytes() for x in v], pa.binary()), pa.array(out, pa.list_(pa.int64()))],
                ["label", "width", "id", "n", "v", "leaves"])

    placed = stored(map_arrow(rest, assign,
                              f"label {label_type}, width int, id long, n long, v binary, leaves array<long>"), "leaves")
    rows = placed.withColumn("leaf", F.explode("leaves"))
    size = rows.groupBy("label", "width", "leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    size = size.select("label", "width", "leaf", F.ceil(F.col("size") / BLOCK).cast("int").alias("k"))
    rows = rows.join(size, ["label", "width", "leaf"]).withColumn("i", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    # a large leaf is dealt into blocks; a task compares two blocks
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("label", "width", "leaf", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "i", "id", "n", "v", "leaves")

    def compare(table):
        ids, count, low = _links_in_block(table, cosine)
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(count, pa.int64()), "low": pa.array(low, pa.int64())})

    ship(vectors.sparkSession)
    found = rows.groupBy("label", "width", "leaf", "lo", "hi").applyInArrow(compare, "id long, links long, low long")
    if pivots:
        found = found.union(_dense(settled, cosine))
    found = stored(found, "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    # vectors equal to a group's vector: the group's links, and its other copies
    copies = real.join(groups.select("label", "v", "id", "n"), ["label", "v"])
    counted = copies.join(links, "id", "left").select("vec_id", "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    counted = stored(counted, "counted")
    edges = found.select(F.col("id").alias("a"), F.col("low").alias("b")).union(counted.select(F.col("id").alias("a"), F.col("vec_id").alias("b")))
    linked = components(edges).select(F.col("id").alias("vec_id"), "component")
    alone = every.where(F.coalesce(~good, F.lit(True))).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    out = counted.select("vec_id", "n_links").union(alone).join(linked, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", "n_links", component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


@query("op1_embedding_dedup")
def op1_embedding_dedup(spark, sf_dir):
    """Links and components of all vectors with equal labels."""
    return near_vectors(load(spark, sf_dir, "embeddings"))
