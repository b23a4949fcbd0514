"""Near-duplicate lines by a segment-partition edit join.

Equal lines are one class at any length, by their hash. Two different lines
link if both have NEAR_CHARS characters, and they are at most ``EDITS``
single-character edits apart and at least 80 percent similar. Of EDITS + 1 even segments of a line, one survives EDITS
edits unchanged, so it occurs in the other line near the same place: a line is
indexed under (its length, segment number, segment) and probes with the
substrings, selected by length and position, that could be a segment of an
equal or shorter line. Pairs that meet are verified with a banded bit-parallel
edit distance. Of each class of linked lines the first in (document, line)
order stays.

Lines are handled as hashes: texts are read where they lie and never
shuffled, but for the few that have to be verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import components, map_arrow, ship, stored
from cairn.llm.registry import query
from cairn.session import load

#: Most edits between linked lines, and their least similarity in percent.
EDITS, PERCENT = 2, 80
#: Least characters of a line that may link to a different one: in a shorter
#: line two edits change its meaning (a number, a date, a name).
NEAR_CHARS = 20
#: Characters hashed at once; lines of a task that are remembered as emitted.
CHUNK, SEEN = 2_000_000, 1_000_000
#: Rows of a key that one task compares; more are dealt out in blocks of BLOCK.
HOT, BLOCK = 20_000, 2_000
#: Lines to verify that may be broadcast (8 bytes each); more are shuffled.
BROADCAST_LINES = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def eligible(line: str) -> bool:
    """Whether a line holds anything but ASCII white space."""
    return bool(line.strip(" \t\n\v\f\r"))


def line_hash(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits between ``a`` and ``b``, or ``most`` + 1 if there are more.

    A word of bits holds the vertical differences of the cells within ``most``
    of the diagonal; it moves down the diagonal by one row per column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    # equal ends don't count
    head = 0
    while head < len(a) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not a:
        return len(b)
    m, n = len(b), len(a)  # rows, columns
    width = 2 * most + 2
    full, bottom = (1 << width) - 1, 1 << (width - 1)
    # the lowest bit of a column j stands for row j + most - width + 1
    up = full & ~((1 << (width - 1 - most)) - 1)
    down, score = 0, min(most, m)
    for j in range(1, n + 1):
        c, equal, row = a[j - 1], 0, j + most - width  # row index in b of the lowest bit
        for k in range(max(0, -row), min(width, m - row)):
            if b[row + k] == c:
                equal |= 1 << k
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & full
        right_up, right_down = down | (full & ~(diagonal | up)), diagonal & up
        if j + most <= m:  # along the band's lowest diagonal
            score += not diagonal & bottom
        else:  # along the last row
            at = bottom >> (j + most - m)
            score += bool(right_up & at) - bool(right_down & at)
        up = right_down | (full & ~((diagonal >> 1) | right_up))
        down = (diagonal >> 1) & right_up
    return min(score, most + 1) if m - n <= most else most + 1


def _cut(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment ``i`` of even segments, the longer ones last."""
    short, longer = length // parts, length % parts
    extra = np.maximum(i - (parts - longer), 0)
    return i * short + extra, short + (i >= parts - longer)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Segmenter:
    """Index and probe keys of lines, from prefix sums of their characters."""

    def __init__(self, edits: int):
        self.edits, self.power, self.inverse = edits, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, lines: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arrays (key, line id, sketch); bit 0 of a sketch is set for probes."""
        with np.errstate(over="ignore"):
            return self._rows(lines, ids)

    def _rows(self, lines, ids):
        chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        length = np.fromiter(map(len, lines), np.int64, len(lines))
        if len(self.power) <= len(chars):
            steps = np.full(len(chars) + 1, _BASE, np.uint64)
            steps[0] = 1
            self.power = np.cumprod(steps)
            steps[1:] = _INVERSE
            self.inverse = np.cumprod(steps)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars + np.uint64(1)) * self.power[:len(chars)])])
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        # an edit touches four pairs of neighbours at most, so it flips four bits at most
        pair = _mix(chars * np.uint64(0x1000193) + np.append(chars[1:], np.uint64(0)))
        bit = np.uint64(1) << (np.uint64(1) + pair % np.uint64(63))
        bit[start + length - 1] = 0  # not over the end of a line
        sketch = np.bitwise_xor.reduceat(bit, start)

        def key(own, of_length, i, at, size):
            x = (sums[at + size] - sums[at]) * self.inverse[at]
            return _mix(_mix(x) + of_length.astype(np.uint64) * np.uint64(0x9E3779B1) + np.uint64(i))

        parts, keys, rows, probe = self.edits + 1, [], [], []
        for shorter in range(parts):  # by how much the line met may be shorter
            target = length - shorter
            for i in range(parts):
                p, size = _cut(target, i, parts)
                low = np.maximum.reduce([np.zeros_like(p), p - i, p + shorter - (self.edits - i)])
                high = np.minimum.reduce([length - size, p + i, p + shorter + (self.edits - i)])
                for k in range(2 * self.edits + 1):
                    at = low + k
                    own = np.flatnonzero((at <= high) & (size > 0))
                    if len(own):
                        keys.append(key(own, target[own], i, start[own] + at[own], size[own]))
                        rows.append(own)
                        # a line's own segments are its index entries
                        probe.append((at[own] != p[own]) if shorter == 0 else np.ones(len(own), bool))
        own, probe = np.concatenate(rows), np.concatenate(probe)
        return np.concatenate(keys).view(np.int64), ids[own], ((sketch[own] & ~np.uint64(1)) | probe).view(np.int64)


def _near(x: np.ndarray, y, edits: int) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64) >> np.uint64(1)) <= 4 * edits


def _pairs(h: np.ndarray, sketch: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) among the rows of a key of which one is an index entry."""
    h, first = np.unique(np.stack([h, sketch & 1]), axis=1, return_index=True)
    index, s = h[1] == 0, sketch[first]
    a, b = [], []
    for r in np.flatnonzero(index):
        other = np.flatnonzero(_near(s, s[r], edits) & (h[0] != h[0][r]) & (~index | (h[0] > h[0][r])))
        a.append(np.minimum(h[0][r], h[0][other]))
        b.append(np.maximum(h[0][r], h[0][other]))
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _lines(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, th, line, h, h2) of the lines that are not blank; th tells texts apart."""

    def run(batches):
        for b in batches:
            doc, line, hashes = [], [], []
            for r, text in enumerate(b.column("text").to_pylist()):
                for k, x in enumerate((text or "").split("\n")):
                    if eligible(x):
                        doc.append(r)
                        line.append(k)
                        hashes.append(line_hash(x))
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at).cast(pa.int64()), b.column("th").take(at), pa.array(line, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])],
                ["doc_id", "th", "line", "h", "h2"])

    return map_arrow(docs.select("doc_id", F.xxhash64("text").alias("th"), "text"), run, "doc_id long, th long, line int, h long, h2 long")


def _batches_of_lines(batches):
    """Lists of the lines that may link to others, each once per task, of about CHUNK characters."""
    seen, lines, ids, size = set(), [], [], 0
    for b in batches:
        for text in b.column("text").to_pylist():
            for x in (text or "").split("\n"):
                if len(x) < NEAR_CHARS or not eligible(x):
                    continue
                h = int.from_bytes(line_hash(x)[:8], "little", signed=True)
                if h in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(h)
                lines.append(x)
                ids.append(h)
                size += len(x)
                if size >= CHUNK:
                    yield lines, ids
                    lines, ids, size = [], [], 0
    if lines:
        yield lines, ids


def _candidates(docs: DataFrame, edits: int) -> DataFrame:
    """Distinct pairs (a, b) of line hashes that may link."""

    def keys(batches):
        segments = Segmenter(edits)
        for lines, ids in _batches_of_lines(batches):
            key, h, sketch = segments(lines, np.array(ids, np.int64))
            for at in range(0, len(key), 100_000):
                own = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(h[own]), pa.array(sketch[own])], ["key", "h", "sketch"])

    def meet(batches):
        """Pairs (a, b, null); rows of a hot key as (h, sketch, key)."""
        held = [np.empty(0, np.int64)] * 3

        def finish(rows):
            key, h, sketch = rows
            if not len(key):
                return
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            several = np.minimum.reduceat(h, start) != np.maximum.reduceat(h, start)
            end = np.append(start[1:], len(key))
            a, b = [], []
            for s, e in zip(start[several], end[several], strict=True):
                x, y = _pairs(h[s:e], sketch[s:e], edits)
                a.append(x)
                b.append(y)
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "key"])

        def hot(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows[1]), pa.array(rows[2]), pa.array(rows[0])], ["a", "b", "key"])

        burning = None  # the key whose rows are passed on
        for batch in batches:
            rows = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, ("key", "h", "sketch"), strict=True)]
            if not len(rows[0]):
                continue
            # the last key may go on in the next batch
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            done, held = [x[:cut] for x in rows], [x[cut:] for x in rows]
            if burning is not None:
                same = int(np.searchsorted(done[0], burning, "right"))
                if same:
                    yield from hot([x[:same] for x in done])
                done = [x[same:] for x in done]
            yield from finish(done)
            if burning != held[0][0]:
                burning = None
            if burning is not None or len(held[0]) > HOT:
                burning = int(held[0][0])
                yield from hot(held)
                held = [x[:0] for x in held]
        if len(held[0]) and burning == held[0][0]:
            yield from hot(held)
        else:
            yield from finish(held)

    texts = docs.select("text")
    rows = map_arrow(texts, keys, "key long, h long, sketch long").repartition("key").sortWithinPartitions("key")
    met = stored(map_arrow(rows, meet, "a long, b long, key long"), "met")
    blazing = met.where("key IS NOT NULL").select("key", F.col("a").alias("h"), F.col("b").alias("sketch")).distinct()
    count = blazing.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    blazing = blazing.join(count, "key").withColumn("i", F.pmod(F.xxhash64("h"), F.col("k")).cast("int"))
    blazing = blazing.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    blazing = blazing.select("key", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "h", "sketch")

    def compare(table):
        a, b = _pairs(table.column("h").to_numpy(), table.column("sketch").to_numpy(), edits)
        return pa.table({"a": a, "b": b})

    ship(docs.sparkSession)
    spread = blazing.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long")
    return met.where("key IS NULL").select("a", "b").union(spread).distinct()


def line_links(docs: DataFrame, edits: int = EDITS, percent: int = PERCENT) -> DataFrame:
    """Links between different lines: rows (a, b, a2, b2) of the first and
    second halves of line hashes, a < b."""
    pairs = stored(_candidates(docs, edits), "line-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    needed = stored(needed, "line-needed")

    def texts(batches):
        for lines, ids in _batches_of_lines(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.string())], ["h", "x"])

    def verify(batches):
        for b in batches:
            ok, second = [], []
            for x, y in zip(b.column("x_a").to_pylist(), b.column("x_b").to_pylist(), strict=True):
                d, longest = edit_distance(x, y, edits), max(len(x), len(y))
                ok.append(d <= edits and 100 * (longest - d) >= percent * longest)
                second.append(line_hash(x)[8:] + line_hash(y)[8:])
            h2 = np.frombuffer(b"".join(second), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(h2[:, 0]), pa.array(h2[:, 1])], ["a", "b", "a2", "b2"]).filter(pa.array(ok, pa.bool_()))

    few = needed.count() <= BROADCAST_LINES
    lines = map_arrow(docs.select("text"), texts, "h long, x string").join(F.broadcast(needed) if few else needed, "h", "left_semi")
    lines = stored(lines.groupBy("h").agg(F.min("x").alias("x")), "line-texts")
    one, two = (lines.select(F.col("h").alias(k), F.col("x").alias(f"x_{k}")) for k in "ab")
    return map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "x_a", "x_b"), verify, "a long, b long, a2 long, b2 long")


def removals(docs: DataFrame, edits: int = EDITS, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, th, n_lines, n_links, removed): per document with lines
    that are not blank their count, the count of those with a near copy that differs, and
    the numbers of the lines to remove. th is the text's xxhash64."""
    lines = stored(_lines(docs).distinct(), "lines")
    links = stored(line_links(docs, edits, percent), "line-links")
    # a line belongs to a class by both halves of its hash
    ends = links.select("a", "a2").union(links.select("b", "b2")).distinct().select(F.col("a").alias("h"), F.col("a2").alias("h2"))
    near = components(links.select("a", "b")).select(F.col("id").alias("h"), "component").join(ends, "h")
    lines = lines.join(near, ["h", "h2"], "left").select("doc_id", "th", "line", F.coalesce("component", "h").alias("c"),
                                                 F.when(F.col("component").isNull(), F.col("h2")).alias("c2"))
    lines = stored(lines, "line-classes")
    first = lines.groupBy(F.col("c").alias("fc"), F.col("c2").alias("fc2")).agg(F.min(F.struct("doc_id", "th", "line")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    classed = lines.join(first, (F.col("c") == F.col("fc")) & F.col("c2").eqNullSafe(F.col("fc2")), "left")
    gone = F.col("first").isNotNull() & ~F.struct("doc_id", "th", "line").eqNullSafe(F.col("first"))
    return classed.groupBy("doc_id", "th").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(F.when(F.col("c2").isNull(), 1)).alias("n_links"),
        F.sort_array(F.collect_list(F.when(gone, F.col("line")))).alias("removed"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, percent: int = PERCENT, drop_emptied: bool = True) -> DataFrame:
    """``docs`` without the lines that repeat or nearly repeat an earlier one.

    Cases: null and empty texts, and blank lines, stay as they are; equal lines are one class at any length; ties between
    documents go by doc_id (null first) and then by text; rows that repeat
    both are one document and end up alike; lines of any length are compared
    whole; an empty table gives no rows; all columns stay. A document that had
    words and has none left is dropped unless ``drop_emptied`` is false.
    """
    out = removals(docs, edits, percent).where(F.size("removed") > 0)
    out = out.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("removed").alias("_gone"))
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_th"))
    joined = whole.join(out, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left")
    text = F.col("_row.text")
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    joined = joined.withColumn("_left", F.when(F.col("_gone").isNull(), text).otherwise(left))
    if drop_emptied:
        joined = joined.where(F.col("_gone").isNull() | F.col("_left").rlike(r"[^\x20\x09-\x0D]"))
    return joined.select(*[F.col("_left").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names])


@query("op3_line_dedup")
def op3_line_dedup(spark, sf_dir):
    """Per document: its lines that are not blank, those linked, and those to remove."""
    docs = load(spark, sf_dir, "documents")
    out = removals(docs)
    own = docs.select("doc_id", F.xxhash64("text").alias("th"))
    out = out.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "n_lines", "n_links", "removed")
    zero = F.lit(0).cast("long")
    return own.join(out, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left").select(
        "doc_id", F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce(F.size("removed").cast("long"), zero).alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))
