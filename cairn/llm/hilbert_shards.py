"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised, each document gets the index of
its cell on a Hilbert curve, the documents are sorted by that index and cut
into runs. Neighbouring cells end up in the same files, so the files' minima
and maxima prune on every dimension at once. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import stored
from cairn.llm.registry import query
from cairn.session import load

SHARDS = 24
#: Bits of each quantised dimension.
BITS = 5


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell (ints in [0, 2 ** bits) per axis).

    The axes are folded bit by bit, from the top: a set bit inverts the lower
    bits of the first axis, a clear one exchanges them with the axis in hand;
    a Gray code then orders the axes' bits. The fold is one higher-order
    expression over an array of ints, so it stays on the JVM for any number
    of axes. Null axes give a null index.
    """
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def fold(x, step):
        q, i, low = step["q"], step["i"], step["q"] - 1
        xi = F.get(x, i)
        swap = F.get(x, F.lit(0)).bitwiseXOR(xi).bitwiseAND(low)

        def cell(v, j):
            inverted = F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)
            exchanged = F.when((j == 0) | (j == i), v.bitwiseXOR(swap)).otherwise(v)
            return F.when(xi.bitwiseAND(q) != 0, inverted).otherwise(exchanged)

        return F.transform(x, cell)

    x = F.aggregate(steps, F.array(*[a.cast("int") for a in axes]), fold) if bits > 1 else F.array(*axes)

    def gray(x):
        # axis i becomes the XOR of axes 0..i
        return F.transform(x, lambda v, i: F.aggregate(F.slice(x, 1, i + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def index(x):
        last = F.get(x, F.lit(n - 1))
        turn = F.aggregate(F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)] or [F.lit(0)]), F.lit(0),
                           lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        order = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
        bit = lambda s: F.call_function("shiftright", F.get(x, s["i"]).bitwiseXOR(turn), s["b"]).bitwiseAND(1)
        return F.aggregate(order, F.lit(0).cast("long"), lambda a, s: a * 2 + bit(s))

    # arrays of one element bind the intermediate results
    grayed = F.transform(F.array(x), gray)
    return F.get(F.transform(grayed, index), F.lit(0))


def _text_cuts(rows: DataFrame, col: str, bits: int) -> list[tuple[str, int]]:
    """(first value, cell) of the cells of a text dimension: values in order,
    cut where the rows before a value reach the next of ``2 ** bits`` equal
    shares. Counts per value are sorted in ranges, and a row per range carries
    the sums across ranges, so no task holds all values; at most ``2 ** bits``
    cuts come back."""
    counts = rows.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = stored(counts.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("part")), "shard-values")
    sums = _before(ranged.groupBy("part").agg(F.sum("n").alias("n")))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("own", within).join(sums, "part")
    cell = F.expr(f"int(((start + own) * {1 << bits}L) div total)")
    return sorted(((r.v, r.cell) for r in placed.groupBy(cell.alias("cell")).agg(F.min("v").alias("v")).collect()), key=lambda x: x[1])


def _before(per_part: DataFrame) -> DataFrame:
    """start, the sum of n over the parts before, and total, beside each part:
    one row per range of a sort, so bounded by the partition count."""
    w = Window.orderBy("part")
    start = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per_part.select("part", start.alias("start"), F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))


def _by_order(c: Column, cuts: list[tuple[str, int]]) -> Column:
    """Cell of a text value among cuts of ``_text_cuts``; null is in cell 0."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(v) for v, _ in cuts]), lambda k: k <= c))
    cells = F.array(F.lit(0), *[F.lit(k) for _, k in cuts])
    return F.when(c.isNull(), 0).otherwise(F.get(cells, below))


def _by_quantile(c: Column, cuts: list, bits: int) -> Column:
    """Cell of a number among equal-depth cut points; null is in cell 0."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda k: k < c)), F.lit(0)).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Rows (doc_id, size, text_crc32, cell, shard, slot) under the law of equal counts.

    The dimensions are source, lang (values in order, cut at equal shares of
    the rows) and the length of the text (cut at approximate quantiles, one
    sketch of fixed size), so a shard holds a narrow range of each. The order
    is (cell, doc_id, text hash); it is total up to repeated rows, which are
    interchangeable. Counts differ by one at most whatever one cell, source or
    copy group holds, as runs are cut by rank, not by key.

    Cases: a null text has size 8 and the CRC of no bytes; null lang, source
    or doc_id are values like others; fewer documents than shards leave
    shards empty; an empty table gives no rows. Only small rows are sorted;
    the texts are read once and not shuffled.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).cast("long")
    base = docs.select("doc_id", "lang", "source", size.alias("size"), crc.alias("text_crc32"),
                       F.xxhash64("text").alias("tie"))
    base = stored(base, "shard-base")
    n_cuts = (1 << bits) - 1
    cuts = base.agg(F.percentile_approx("size", [(i + 1) / (n_cuts + 1) for i in range(n_cuts)], 2000)).first()[0] or []
    axes = [_by_order(F.col("source"), _text_cuts(base, "source", bits)), _by_quantile(F.col("size"), sorted(set(cuts)), bits),
            _by_order(F.col("lang"), _text_cuts(base, "lang", bits))]
    cells = base.select("doc_id", "size", "text_crc32", "tie", hilbert_index(axes, bits).alias("cell"))
    # ranges over (cell, doc_id, tie): a cell with a third of the rows is split
    ranged = cells.repartitionByRange("cell", "doc_id", "tie").sortWithinPartitions("cell", "doc_id", "tie")
    mid = F.monotonically_increasing_id()
    numbered = stored(ranged.select("doc_id", "size", "text_crc32", "cell", mid.alias("mid"))
                      .select("doc_id", "size", "text_crc32", "cell",
                              F.shiftright("mid", 33).cast("int").alias("part"),
                              F.col("mid").bitwiseAND((1 << 33) - 1).alias("at")), "shard-order")
    per_part = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = _before(per_part)
    ranked = numbered.join(starts, "part").withColumn("rank", F.col("start") + F.col("at"))
    k = F.lit(shards).cast("long")
    # shard s holds the ranks from ceil(s * total / k) to ceil((s + 1) * total / k) - 1
    ranked = ranked.withColumn("s", F.expr(f"(rank * {shards}L) div total"))
    first = F.expr(f"(s * total + {shards - 1}L) div {shards}L")
    return ranked.select("doc_id", "size", "text_crc32", "cell", F.col("s").cast("int").alias("shard"),
                         (F.col("rank") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole documents as one folder per shard, in curve order.

    Documents are matched to their shard by (doc_id, size, CRC): rows equal in
    all three are interchangeable copies, told apart by their number.
    """
    key = [F.col("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8,
           F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).cast("long")]
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       key[0].alias("k0"), key[1].alias("k1"), key[2].alias("k2"))
    left = left.withColumn("copy", F.row_number().over(Window.partitionBy("k0", "k1", "k2").orderBy(F.lit(0))))
    right = shard(docs, shards).select(F.col("doc_id").alias("k0"), F.col("size").alias("k1"), F.col("text_crc32").alias("k2"), "shard", "slot")
    right = right.withColumn("copy", F.row_number().over(Window.partitionBy("k0", "k1", "k2").orderBy("shard", "slot")))
    on = [left[c].eqNullSafe(right[c]) for c in ("k0", "k1", "k2", "copy")]
    out = left.join(right, on).select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    out.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").drop("_slot").write.partitionBy("_shard").parquet(path)


@query("op8_hilbert_shards")
def op8_hilbert_shards(spark, sf_dir):
    """All documents in 24 shards, counts at most one apart."""
    return shard(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell")
