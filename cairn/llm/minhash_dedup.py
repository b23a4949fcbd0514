"""Near-duplicate documents with b-bit MinHash.

Documents with equal shingle sets collapse first. Each remaining set keeps
the low 8 bits of its minima under many hash functions; runs of five minima
are band keys that generate candidates, and the matching bits of two packed
signatures, corrected for chance collisions, estimate the similarity. Pairs
that pass the estimate are confirmed on the full sets.

Groups are never expanded into all pairs. A band bucket links its members to
its smallest one; members that connect need no further test. What is still
apart is settled inside groups that hold every pair of candidates: only the
documents outside a group's largest component are compared with the others,
on full sets, in tasks that hold two blocks of bounded size. So no link between
candidates is lost however large a bucket or a group is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import components, map_arrow, stored
from cairn.llm.registry import query
from cairn.session import load

#: Production parameters of the contract: shingle words, similarity in percent.
SHINGLE, PERCENT = 2, 80
#: 40 bands of 5 minima miss a pair of similarity 0.8 with probability 1e-7.
BANDS, ROWS, BITS = 40, 5, 8
#: Six standard deviations of the estimate below the threshold.
MARGIN = 0.17
#: Signatures compared at once inside a task.
BLOCK = 512
#: Parts that the members of one bucket or group are dealt over in a join.
SALTS = 32
#: Rounds of single pairs before the groups.
ROUNDS = 3
#: Shingles of a block of full sets.
TOKENS = 400_000
#: Distinct words a task's table holds before it starts a new one.
TABLE_WORDS = 400_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """64-bit hash of a word; a bounded table."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= TABLE_WORDS:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle, self.words = shingle, _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.split() parts at ASCII white space: blank and 0x09 to 0x0D
        own = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        h = np.fromiter(map(self.words.__getitem__, own), np.uint64, len(own))
        n = min(self.shingle, len(h))
        if not n:
            return h
        with np.errstate(over="ignore"):
            x = h[:len(h) - n + 1]
            for k in range(1, n):
                x = _mix(x) + h[k:len(h) - n + 1 + k]
            # a short text's whole sequence is no shingle of a longer one
            return np.unique(_mix(x + np.uint64(n)))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    return (r.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))[:, None], r.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Low 8 bits of the minima of ``a * x + b`` over non-empty shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    step = 1024
    for at in range(0, len(x), step):
        np.minimum(low, (a * x[at:at + step] + b).min(axis=1), out=low)
    # the minimum's place decides its low bits, not the function's low bits
    return (_mix(low.astype(np.uint64)) >> np.uint64(20)).astype(np.uint8)


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity from the equal lanes of packed signatures (... x lanes bytes).

    The lanes' differing bits are folded onto one bit each and counted; equal
    lanes occur by chance once in 2 ** BITS, which is taken off.
    """
    d = np.ascontiguousarray(x ^ y).view(np.uint64)
    for s in (4, 2, 1):
        d = d | (d >> np.uint64(s))
    differ = np.bitwise_count(d & np.uint64(0x0101010101010101)).sum(axis=-1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return (1 - differ / x.shape[-1] - chance) / (1 - chance)


def _bytes_matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, n_shingles, set_hash, sig); the last two null for empty sets."""
    lanes = BANDS * ROWS

    def run(batches):
        shingles, (a, b) = Shingler(shingle), _functions(lanes)
        for batch in batches:
            n, hashes, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                x = shingles(text)
                n.append(len(x))
                hashes.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
                sigs.append(signature(x, a, b).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "set_hash", "sig"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, set_hash binary, sig binary")


def _estimated(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose estimate reaches ``least``, with it."""

    def run(batches):
        for p in batches:
            if p.num_rows:
                e = estimate(_bytes_matrix(p.column("sig_a"), BANDS * ROWS), _bytes_matrix(p.column("sig_b"), BANDS * ROWS))
                yield pa.RecordBatch.from_arrays([p.column("a"), p.column("b"), pa.array(e)], ["a", "b", "est"])

    one, two = (sets.select(F.col("id").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "ab")
    return map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b"), run, "a long, b long, est double").where(F.col("est") >= least)


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity.

    Texts of the documents in pairs are turned into sorted shingle hashes;
    ``a`` is the hub of a star, so rows are sorted by it and stream past.
    """

    def to_sets(batches):
        shingles = Shingler(shingle)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([shingles(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())], ["id", "s"])

    def compare(batches):
        for p in batches:
            ok, held, x = [], None, None
            for s, t in zip(p.column("s_a").to_pylist(), p.column("s_b").to_pylist(), strict=True):
                if s is not held and s != held:
                    held, x = s, np.frombuffer(s, np.uint64)
                y = np.frombuffer(t, np.uint64)
                # both sides are distinct and sorted
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([p.column("a"), p.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(needed, "id", "left_semi")
    sets = stored(map_arrow(texts, to_sets, "id long, s binary"), "sets")
    one, two = (sets.select(F.col("id").alias(k), F.col("s").alias(f"s_{k}")) for k in "ab")
    return map_arrow(pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "s_a", "s_b"), compare, "a long, b long")


def _beside(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``rows`` joined on ``key`` with ``small``, which has few rows per key: both
    are dealt by the key and a salt, so that a key with most of the rows is not
    one task's."""
    salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(small.withColumn("_salt", F.explode(salt)), [key, "_salt"]).drop("_salt")


def _apart(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) among members (key, id, component) of one bucket that are
    in different components, neither the bucket's smallest member, with an
    estimate of ``least`` or more.

    A bucket is dealt into blocks of about BLOCK members; a task compares two
    blocks at a time.
    """
    size = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    size = size.where("c0 <> c1 AND n > 2").select("key", "low", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    rows = _beside(members, size, "key").where("id <> low").withColumn("i", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    # block pairs (i, j), i <= j, that a row's block belongs to
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("key", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "i", "id", "component")
    rows = rows.join(sets.select("id", "sig"), "id")

    def compare(table):
        i, ids, comp = (table.column(x).to_numpy() for x in ("i", "id", "component"))
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        sig = _bytes_matrix(table.column("sig"), BANDS * ROWS)
        left, right = np.flatnonzero(i == lo), np.flatnonzero(i == hi)
        a, b = [], []
        for r in left:
            other = right[(comp[right] != comp[r]) & ((ids[right] > ids[r]) | (lo != hi))]
            if len(other):
                other = other[estimate(sig[r][None, :], sig[other]) >= least]
                a.append(np.minimum(ids[r], ids[other]))
                b.append(np.maximum(ids[r], ids[other]))
        none = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return rows.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _within(groups: DataFrame, linked: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between different components inside groups (id, group, star),
    where star names the documents that stars alone connect.

    Members of a group's largest component are met by the others only. Both
    sides are dealt into blocks of about TOKENS shingles; a task holds two
    blocks, compares full sets, and returns for each minor member one link per
    component, the smallest.
    """
    nodes = groups.join(linked, "id", "left").select("id", "group", "star", F.coalesce("component", "id").alias("component"))
    parts = nodes.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"), F.min("star").alias("s0"), F.max("star").alias("s1"))
    many = parts.groupBy("group").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", F.negative("component").alias("c"))).alias("top"), F.min("s0").alias("s0"), F.max("s1").alias("s1"))
    # a pair of one star has been confirmed or refused in the first round; one
    # that was met in a bucket only joins two stars, and is still to be compared
    many = many.where("parts > 1 AND (n > 2 OR s0 <> s1)").select("group", F.negative("top.c").alias("main"))
    nodes = stored(_beside(nodes, many, "group").select("id", "group", "component", (F.col("component") != F.col("main")).alias("minor")), "group-members")

    def to_sets(batches):
        shingles = Shingler(shingle)
        for b in batches:
            own = [shingles(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.tobytes() for x in own], pa.binary())], ["id", "s"])

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(nodes.select("id"), "id", "left_semi")
    rows = map_arrow(texts, to_sets, "id long, s binary").join(nodes, "id")
    rows = stored(rows.select("group", "id", "component", "minor", "s", F.octet_length("s").alias("bytes")), "group-sets")
    blocks = lambda c: F.greatest(F.ceil(c / (8 * TOKENS)), F.lit(1)).cast("int")
    size = rows.groupBy("group").agg(blocks(F.sum("bytes")).alias("k"), blocks(F.sum(F.when(F.col("minor"), F.col("bytes")))).alias("m"))
    rows = _beside(rows, size, "group").drop("bytes")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumn("j", deal("k")).withColumn("left", F.lit(False))
    minor = rows.where("minor").withColumn("i", deal("m")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("left", F.lit(True))
    rows = every.unionByName(minor).select("group", "i", "j", "left", "id", "component", "s")

    def compare(table):
        left, ids, comp = (table.column(x).to_numpy(zero_copy_only=False) if x == "left" else table.column(x).to_numpy() for x in ("left", "id", "component"))
        tokens = [np.frombuffer(x, np.uint64) for x in table.column("s").to_pylist()]
        own, other = np.flatnonzero(left), np.flatnonzero(~left)
        found: set[tuple[int, int]] = set()
        if len(own) and len(other):
            n = np.array([len(t) for t in tokens])
            _, number = np.unique(np.concatenate(tokens), return_inverse=True)
            number = np.split(number, np.cumsum(n)[:-1])
            flat = np.concatenate([number[r] for r in other])
            start = np.concatenate([[0], np.cumsum(n[other])[:-1]])
            mark = np.zeros(int(max(x.max() for x in number)) + 1, np.int32)
            for r in own:
                mark[number[r]] = 1
                common = np.add.reduceat(mark[flat], start)
                mark[number[r]] = 0
                hit = other[(100 * common >= percent * (n[other] + n[r] - common)) & (comp[other] != comp[r])]
                if len(hit):
                    _, first = np.unique(comp[hit], return_index=True)
                    found |= {(min(x, y), max(x, y)) for x, y in ((int(ids[r]), int(ids[h])) for h in hit[first])}
        a, b = zip(*sorted(found), strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Cases: null, empty and blank texts have no shingles and link with nothing;
    a text of fewer words than a shingle is one shingle; texts are read whole;
    rows that repeat a doc_id share a component if they link, and so does all
    that either links with; rows with a null doc_id stand alone (component
    null, kept false, as nothing names them); an empty table gives no rows.
    Other columns are not read.
    """
    least = percent / 100 - MARGIN
    every = stored(signatures(docs, shingle), "signatures")
    real = every.where("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    # copies collapse to their smallest document, map-side
    groups = real.groupBy("set_hash").agg(F.min(F.struct("doc_id", "sig")).alias("m"))
    groups = stored(groups.select("set_hash", F.col("m.doc_id").alias("id"), F.col("m.sig").alias("sig")), "groups")
    copies = real.join(groups.select("set_hash", "id"), "set_hash").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")).distinct()
    sets = groups.select("id", "sig")

    def banded(batches):
        for b in batches:
            sig = _bytes_matrix(b.column("sig"), BANDS * ROWS).reshape(-1, BANDS, ROWS).astype(np.int64)
            key = np.repeat(np.arange(BANDS, dtype=np.int64)[None, :], len(sig), 0)
            for r in range(ROWS):
                key = (key << BITS) | sig[:, :, r]
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(b.column("id").to_numpy(), BANDS))], ["key", "id"])

    bands = map_arrow(sets, banded, "key long, id long")
    buckets = bands.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members = stored(bands.join(buckets.select("key", "low"), "key"), "members")
    star = members.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    star = stored(_estimated(star, sets, least), "star")
    # a pair per document and round, the most similar that is still apart
    best = Window.partitionBy("b").orderBy(F.desc("est"), "a")
    links, left = None, star
    for _ in range(ROUNDS):
        first = stored(left.withColumn("r", F.row_number().over(best)).where("r = 1").select("a", "b"), "first")
        left = left.join(first, ["a", "b"], "left_anti")
        met = _confirmed(first, docs, shingle, percent)
        links = stored(links.union(met) if links else met, "links")
        joined = components(links)
        left = stored(left.join(_open(left, joined), ["a", "b"], "left_semi"), "open")
    # groups that hold every pair of candidates, and what is still apart in them
    near = components(star)
    named = members.join(near, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    more = stored(_apart(named, sets, least), "more")
    whole = components(star.select("a", "b").union(more)).withColumnRenamed("component", "group")
    near = whole.join(near, "id", "left").select("id", "group", F.coalesce("component", "id").alias("star"))
    links = stored(links.union(_within(near, joined, docs, shingle, percent)), "links")
    linked = components(links.union(copies))
    out = every.join(linked.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    # equal doc_ids are one document; those without a component stand alone
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def _open(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """Pairs (a, b) not yet in one component."""
    a, b = (linked.select(F.col("id").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
    return pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


@query("op10_minhash_dedup")
def op10_minhash_dedup(spark, sf_dir):
    """Components of near-duplicate documents."""
    return near_duplicates(load(spark, sf_dir, "documents"))
