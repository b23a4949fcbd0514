"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent.

Each row is a leaf. The leaves of a source, in order of doc_id, are hashed in
runs of ARITY up to the source's subroot, and the subroots, in order of source,
up to the root. Every run is stored as a record from its digest to its
children's digests, by height.

A leaf is asked for by its rank. The digits of the rank (base ARITY) choose a
child at each record on the way down from the root; the children that are not
chosen are collected, one segment a level, and the segments are reversed into
the proof, which runs from the leaf up. Requests that share their first digits
go down together, so a level costs a join of its distinct nodes with its
records; the levels shrink by ARITY, and the leaves' level sums up the work.
All of it is joins and grouping by keys that split any hot source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import stored
from cairn.llm.registry import query
from cairn.session import load

ARITY = 3
#: Heights after which a frontier on its way down is written.
REST = 4
NODE = "tree long, pos long, n long, digest binary, children array<binary>"


def sha(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of a text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def hexed(digests: Column) -> Column:
    """Concatenated hexadecimal digests of an array of binary ones."""
    return F.lower(F.array_join(F.transform(digests, F.hex), ""))


def field(c: Column) -> Column:
    """A value as hashed into a leaf: ``-`` if null, else its UTF-8 bytes' count, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(text: Column) -> Column:
    """Digest of a row of ``documents`` whose text is ``text``."""
    return F.unhex(sha(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(F.col("n_chars")), field(text))))


def without_line_feeds(text: Column) -> Column:
    """The tampering of the contract: line feeds go, where 2 divides the CRC-32 of the doc_id; else the text itself."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def numbered(rows: DataFrame, order: list[str], by: str) -> DataFrame:
    """Rows with pos, their place among those of equal ``by``, and n, how many these are.

    Sorted in ranges of (by, order, place in the input), so that no value of
    ``by`` and no repeated row needs a task of its own; a row per range and
    value of ``by`` carries the counts across ranges.
    """
    names = rows.columns
    keys = [by, *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = stored(ranged.withColumn("_mid", F.monotonically_increasing_id()).drop("_tie"), "manifest-order")
    at = at.withColumn("_part", F.shiftright("_mid", 33))
    runs = at.groupBy("_part", by).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(by)
    runs = stored(runs.select(
        F.col("_part").alias("_p"), F.col(by).alias("_b"),
        (F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(own).alias("n")), "manifest-runs")
    on = (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_b"))
    return at.join(runs, on).select(*names, (F.col("_mid") + F.col("_shift")).alias("pos"), "n")


def levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Nodes by height, from ``nodes(tree, pos, n, digest)`` up; n counts a tree's nodes of that height.

    A level has every node of the trees that have more than one below it.
    ``most`` is the largest n.
    """
    out = [nodes]
    while most > 1:
        up = out[-1].where("n > 1").groupBy("tree", F.expr(f"pos div {ARITY}").alias("pos"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
        runs = up.agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("pos").alias("p"), "digest"))), lambda x: x["digest"]).alias("children"))
        out.append(stored(runs.select("tree", "pos", "n", F.unhex(sha(hexed(F.col("children")))).alias("digest"), "children"), "manifest-level"))
        most = -(-most // ARITY)
    return out


def roots(of: list[DataFrame]) -> DataFrame:
    """Rows (tree, digest, height): the top node of each tree."""
    every = [lv.where("n = 1").select("tree", "digest", F.lit(h).alias("height")) for h, lv in enumerate(of)]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """Stored tables of a manifest.

    leaves: every row's doc_id, tree (number of its source), pos, n, digest,
    and altered, the digest of the altered text if it was asked for.
    levels, top: nodes by height of the sources' trees and of the tree over
    their subroots; ``records`` are their digest-to-children rows.
    subroots: tree, digest, height. root: the root in hexadecimal, None
    without rows.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame | None
    top: list[DataFrame]
    root: str | None


def build(docs: DataFrame, altered=None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    Each row is a leaf. Cases: a null in any column is hashed as ``-``; null
    sources are one source, before all others; null doc_ids come first in
    theirs; equal (source, doc_id) are ordered by leaf digest, so repeated
    rows are equal leaves side by side; an empty text differs from a null
    one; texts are hashed whole; an empty table has no root; other columns
    are not read. ``altered`` maps the text column to one whose digest is
    kept beside the leaf's.
    """
    base = docs.select("doc_id", "source", leaf(F.col("text")).alias("digest"),
                       (leaf(altered(F.col("text"))) if altered else F.lit(None).cast("binary")).alias("altered"))
    at = stored(numbered(stored(base, "manifest-leaves"), ["doc_id", "digest"], "source"), "manifest-leaves")
    sources = numbered(at.where("pos = 0").select("source", F.lit(0).alias("all")), ["source"], "all")
    sources = stored(sources.select(F.col("source").alias("_s"), F.col("pos").alias("tree")), "manifest-sources")
    leaves = stored(at.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "tree", "pos", "n", "digest", "altered"), "manifest-leaves")
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(leaves, [leaves], None, [], None)
    below = levels(leaves.select("tree", "pos", "n", "digest"), most)
    subroots = stored(roots(below), "manifest-subroots")
    n = subroots.count()
    top = levels(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n).cast("long").alias("n"), "digest"), n)
    return Manifest(leaves, below, subroots, top, roots(top).first()["digest"].hex())


def records(level: DataFrame) -> DataFrame:
    """Digest-to-children records of a level; equal runs share one."""
    return level.select("digest", "children").distinct()


def _up(wanted: DataFrame) -> DataFrame:
    """Nodes one height up that lead to wanted ones: tree, pos, and the digits to follow as bits."""
    return wanted.groupBy("tree", F.expr(f"pos div {ARITY}").alias("pos")).agg(
        F.expr(f"bit_or(shiftleft(1, int(pos % {ARITY})))").alias("digits"))


def _split(children: Column, digit: Column) -> Column:
    """The segment of a level: the children left and right of the chosen one."""
    return F.struct(F.slice(children, F.lit(1), digit).alias("left"),
                    F.slice(children, digit + 2, F.lit(ARITY)).alias("right"))


def _down(frontier: DataFrame, level: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted children of the frontier's nodes, each with its parent's segments and its own."""
    f = frontier.join(wanted, ["tree", "pos"]).join(records(level), "digest")
    digit = F.explode(F.filter(F.sequence(F.lit(0), F.size("children") - 1), lambda d: F.expr("digits").bitwiseAND(F.call_function("shiftleft", F.lit(1), d)) != 0))
    f = f.select("tree", "pos", "subroot", "segments", "children", digit.alias("digit"))
    return f.select("tree", (F.col("pos") * ARITY + F.col("digit")).alias("pos"), F.get("children", F.col("digit")).alias("digest"), "subroot",
                    F.concat("segments", F.array(_split(F.col("children"), F.col("digit")))).alias("segments"))


def proofs(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, leaf, altered, subroot, segments) of the asked leaves.

    ``requests`` are rows of ``m.leaves`` (all, if not given). ``segments``
    run from the leaf up to the root: per level the digests left and right of
    the path, empty where a run is one node. Found by descent: only the
    records on the way to an asked leaf are opened.
    """
    asked = m.leaves if requests is None else requests
    none = F.array().cast("array<struct<left:array<binary>,right:array<binary>>>")
    # the way down to the subroots of the asked sources
    trees = stored(asked.groupBy("tree").agg(F.max("n").alias("n")), "manifest-asked")
    wanted = [trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"))]
    for _ in m.top[1:]:
        wanted.append(_up(wanted[-1]))
    frontier = roots(m.top).select("tree", F.lit(0).cast("long").alias("pos"), "digest", F.lit(None).cast("binary").alias("subroot"), none.alias("segments"))
    for h in range(len(m.top) - 1, 0, -1):
        frontier = _down(frontier, m.top[h], wanted[h])
    starts = frontier.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "digest", F.col("digest").alias("subroot"), "segments")
    starts = stored(starts.join(m.subroots.select("tree", "height"), "tree"), "manifest-starts")
    # the way down to the leaves; the lowest record holds the requests of its run
    payload = F.struct(F.expr(f"int(pos % {ARITY})").alias("digit"), "doc_id", F.col("digest").alias("leaf"), "altered")
    runs = stored(asked.where("n > 1").groupBy("tree", F.expr(f"pos div {ARITY}").alias("pos")).agg(F.collect_list(payload).alias("asked")), "manifest-asked")
    wanted = [None, runs]
    for _ in m.levels[2:]:
        wanted.append(stored(_up(wanted[-1]), "manifest-asked"))
    nodes = ["tree", "pos", "digest", "subroot", "segments"]
    frontier = None
    for h in range(len(m.levels) - 1, 0, -1):
        fresh = starts.where(F.col("height") == h).select(nodes)
        frontier = fresh if frontier is None else frontier.unionByName(fresh)
        if h > 1:
            frontier = _down(frontier, m.levels[h], wanted[h])
            if h % REST == 0:
                frontier = stored(frontier, "manifest-frontier")
    columns = ["doc_id", "leaf", "altered", "subroot", F.reverse("segments").alias("segments")]
    alone = asked.where("n = 1").select("tree", "doc_id", F.col("digest").alias("leaf"), "altered")
    out = alone.join(starts, "tree").select(columns)
    if frontier is not None:
        low = frontier.join(runs, ["tree", "pos"]).join(records(m.levels[1]), "digest")
        low = low.select("subroot", "segments", "children", F.explode("asked").alias("a")).select("subroot", "segments", "children", "a.*")
        whole = F.concat("segments", F.array(_split(F.col("children"), F.col("digit"))))
        out = out.unionByName(low.withColumn("segments", whole).select(columns))
    return out


def folded(digest: Column, segments: Column) -> Column:
    """The root in hexadecimal that a leaf's digest and a proof's segments lead to."""
    return F.aggregate(segments, F.lower(F.hex(digest)), lambda acc, s: sha(F.concat(hexed(s["left"]), acc, hexed(s["right"]))))


def verify(docs: DataFrame, altered=without_line_feeds) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every
    row: its proof, and whether the altered text still leads to the root. Cases as in ``build``."""
    m = build(docs, altered)
    if m.root is None:
        return m.leaves.selectExpr("doc_id", "hex(digest) leaf", "hex(digest) subroot", "hex(digest) root",
                                   "hex(digest) proof_sha256", "hex(digest) folded_root", "true verified")
    path = F.transform("segments", lambda s: F.concat(hexed(s["left"]), hexed(s["right"])))
    out = proofs(m).select(
        "doc_id", F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), F.lit(m.root).alias("root"),
        sha(F.array_join(path, "")).alias("proof_sha256"), folded(F.col("altered"), F.col("segments")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = r"""
WITH RECURSIVE
t AS (
  SELECT *, CASE WHEN list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) & 1 = 1
    THEN replace(text, chr(10), '') ELSE text END AS alt
  FROM documents),
b AS (
  SELECT doc_id, source,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN alt IS NULL THEN '-' ELSE strlen(alt) || ':' || alt END) AS alt
  FROM (SELECT *,
      CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
      || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head FROM t)),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM b),
up AS (
  SELECT tree, pos, 0 AS h, leaf AS d, n FROM l
  UNION ALL
  SELECT tree, pos // 3, h + 1, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, pos // 3, h, n),
s AS (SELECT tree, d AS subroot, h FROM up WHERE n = 1),
top AS (
  SELECT tree AS pos, 0 AS h, subroot AS d, (SELECT count(*) FROM s) AS n FROM s
  UNION ALL
  SELECT pos // 3, h + 1, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY pos // 3, h, n),
path AS (
  SELECT l.tree, l.pos AS leaf_pos, l.h AS step, u.d, u.pos < l.at AS before, u.pos
  FROM (SELECT tree, pos, unnest(range(20)) AS h, pos // CAST(3 ** unnest(range(20)) AS BIGINT) AS at FROM l) l
  JOIN up u ON u.tree = l.tree AND u.h = l.h AND u.pos // 3 = l.at // 3 AND u.pos <> l.at
  UNION ALL
  SELECT l.tree, l.pos, 100 + t.h, t.d, t.pos < l.tree // CAST(3 ** t.h AS BIGINT), t.pos
  FROM l JOIN top t ON t.pos // 3 = l.tree // CAST(3 ** (t.h + 1) AS BIGINT) AND t.pos <> l.tree // CAST(3 ** t.h AS BIGINT)),
steps AS (
  SELECT l.tree, l.pos, k.step, coalesce(p.le, '') AS le, coalesce(p.ri, '') AS ri, row_number() OVER (PARTITION BY l.tree, l.pos ORDER BY k.step) AS i
  FROM l JOIN (SELECT tree, unnest(range(h)) AS step FROM s UNION ALL SELECT tree, 100 + unnest(range((SELECT max(h) FROM top))) FROM s) k ON k.tree = l.tree
  LEFT JOIN (SELECT tree, leaf_pos, step, string_agg(CASE WHEN before THEN d END, '' ORDER BY pos) AS le,
                    string_agg(CASE WHEN NOT before THEN d END, '' ORDER BY pos) AS ri FROM path GROUP BY ALL) p
    ON p.tree = l.tree AND p.leaf_pos = l.pos AND p.step = k.step),
fold AS (
  SELECT tree, pos, CAST(0 AS BIGINT) AS i, alt AS d FROM l
  UNION ALL
  SELECT f.tree, f.pos, f.i + 1, sha256(x.le || f.d || x.ri) FROM fold f JOIN steps x ON x.tree = f.tree AND x.pos = f.pos AND x.i = f.i + 1),
last AS (SELECT tree, pos, arg_max(d, i) AS folded FROM fold GROUP BY tree, pos),
proof AS (SELECT tree, leaf_pos, sha256(string_agg(d, '' ORDER BY step, pos)) AS proof FROM path GROUP BY tree, leaf_pos)
SELECT l.doc_id, l.leaf, s.subroot, r.d AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.folded AS folded_root, f.folded = r.d AS verified
FROM l JOIN s USING (tree) JOIN last f USING (tree, pos) LEFT JOIN proof p ON p.tree = l.tree AND p.leaf_pos = l.pos, (SELECT d FROM top WHERE n = 1) r
"""


@query("op12_merkle_manifest", SQL)
def op12_merkle_manifest(spark, sf_dir):
    """The proof of every document, and whether its tampered text is found out."""
    return verify(load(spark, sf_dir, "documents"))
