"""Packing token sequences by non-negative least squares.

A document's ids are cut into full windows and one remainder, so a piece and
its checksum depend on the document alone and texts are tokenized once. The
remainders' lengths are counted in a histogram of fixed size; shallow length
combinations that fill a window are enumerated, their repeat counts solved by
non-negative least squares against the histogram and rounded down, and what
is left is packed greedily. The driver sees only the histogram; pieces find
their place from their rank within their length class.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import map_arrow, stored
from cairn.llm.registry import query
from cairn.session import load

WINDOW = 2048
END_ID = 1
#: Lengths up to FINE are classes of their own, longer ones share STEP lengths.
FINE, STEP = 32, 16
#: Pieces in an enumerated combination.
DEPTH = 3
#: Texts tokenized at once.
BATCH = 32
#: Distinct words a task's table holds before it starts a new one.
TABLE_WORDS = 1_200_000
#: Latin letters, and a stop or comma: the tokenizer's normalizer only lowers
#: these letters, and its split puts the mark apart.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


def _lowered(text: str) -> str:
    """A text in lower case where the tokenizer's own lowering is the same: in
    Latin-1, and without the strings of special tokens."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class WordIds:
    """Ids of texts, with a bounded table of the words seen by this task.

    The tokenizer drops white space and no token spans it, so the ids of a
    text are those of its parts between blanks and line feeds, in order.
    """

    def __init__(self, path: str, table_words: int = TABLE_WORDS):
        self.table_words = table_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for words that are lower-case letters already: the same model alone
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        #: ids that end a word
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.kind = "<u2" if len(self.last) <= 1 << 16 else "<u4"
        self.table: dict[str, bytes] = {"": b""}

    def _whole(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.table[w] = np.array(e.ids, dtype=self.kind).tobytes()

    def _letters(self, words: list[str]) -> None:
        """Words of lower-case letters, many in a call: every word ends in an id that ends a word."""
        lines = [" ".join(words[at:at + 100]) for at in range(0, len(words), 100)]
        ids = np.array([i for e in self.plain.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], dtype=self.kind)
        ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
        if len(ends) != len(words):
            return self._whole(words)
        flat = ids.tobytes()
        start = 0
        for w, end in zip(words, ends.tolist(), strict=True):
            self.table[w] = flat[start:end]
            start = end

    def _learn(self, new) -> None:
        """Adds words that the table lacks."""
        table = self.table
        parts, others = [], [m for m in ".," if m not in table]
        for w in new:
            if m := _PLAIN.fullmatch(w):
                parts.append((w, m[1].lower(), m[2]))
            else:
                others.append(w)
        self._letters(list({b for _, b, _ in parts}.difference(table)))
        self._whole(others)
        for w, bare, mark in parts:
            table[w] = table[bare] + table[mark]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text."""
        split = [_lowered(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.table) > self.table_words:
            self.table = {"": b""}
        if new := set().union(*split).difference(self.table):
            self._learn(new)
        get = self.table.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype=self.kind).astype("<u4") for words in split]


@functools.lru_cache(maxsize=2)
def _word_ids(path: str, table_words: int) -> WordIds:
    return WordIds(path, table_words)


def length_class(length: int) -> int:
    """Number of a length's class; ``CEILING`` holds the class's largest length."""
    return length - 1 if length <= FINE else FINE - 1 + -(-(length - FINE) // STEP)


CEILING = [*range(1, FINE + 1), *range(FINE + STEP, WINDOW + 1, STEP)]


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False, table_words: int = TABLE_WORDS) -> DataFrame:
    """Documents cut at whole windows: doc_id, start, length, ids_crc32,
    doc_tokens, and part, class, at: the piece's number within its length
    class among those of its task. ``with_ids`` adds the ids themselves.
    """

    def run(batches):
        ids_of, part, seen = _word_ids(tokenizer, table_words), TaskContext.get().partitionId(), [0] * len(CEILING)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "class", "at"]
        for b in batches:
            rows, cut = [], []
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = (x for at in range(0, len(texts), BATCH) for x in ids_of(texts[at:at + BATCH]))
            for doc, ids in zip(b.column("doc_id").to_pylist(), found, strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), WINDOW):
                    own = ids[start:start + WINDOW]
                    k = length_class(len(own))
                    rows.append((doc, start, len(own), zlib.crc32(own.tobytes()), len(ids), part, k, seen[k]))
                    seen[k] += 1
                    if with_ids:
                        cut.append(own.astype("i4"))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(names)
            if with_ids:
                columns.append(pa.array(cut, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, class long, at long"
    return map_arrow(docs.select("doc_id", "text"), run, schema + ", ids array<int>" * with_ids)


def combinations() -> list[tuple[int, ...]]:
    """Classes, largest first, of at most DEPTH pieces whose ceilings fill a window."""
    by_size = {c: k for k, c in enumerate(CEILING)}

    def grow(left: int, most: int, depth: int):
        if left == 0:
            yield ()
        elif depth:
            for c in range(min(left, most), 0, -1):
                if c in by_size and c * depth >= left:
                    for rest in grow(left - c, c, depth - 1):
                        yield (by_size[c], *rest)

    return list(grow(WINDOW, WINDOW, DEPTH))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Least squares of ``a x = b`` with ``x >= 0``, by an active set."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] <= 1e-9:
            break
        free[k] = True
        while True:
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if s[free].min(initial=1) > 0:
                break
            bad = free & (s <= 0)
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
        x = s
    return x


def plan(counts: dict[int, int]) -> list[tuple[int, dict[int, int]]]:
    """Patterns (repeats, pieces per class) that use up ``counts`` by class.

    Bounded by the number of length classes, whatever the counts are.
    """
    left = np.zeros(len(CEILING), dtype=np.int64)
    for k, n in counts.items():
        left[k] = n
    out: list[tuple[int, dict[int, int]]] = []

    def use(repeats: int, pattern: dict[int, int]) -> None:
        if repeats > 0:
            out.append((repeats, pattern))
            for k, m in pattern.items():
                left[k] -= repeats * m

    use(int(left[-1]), {len(CEILING) - 1: 1})  # full windows
    total = int(left.sum())
    if total:
        found = [c for c in combinations() if all(left[k] for k in c)]
        if found:
            a = np.zeros((len(CEILING), len(found)))
            for j, c in enumerate(found):
                for k in c:
                    a[k, j] += 1
            x = nnls(a, left / total) * total
            for j in np.argsort(-x):
                pattern = {k: found[j].count(k) for k in found[j]}
                use(min(int(x[j]), *(int(left[k]) // m for k, m in pattern.items()), int(x[j])), pattern)
    while left.any():
        room, pattern = WINDOW, {}
        for k in np.flatnonzero(left)[::-1]:
            if m := min(int(left[k]), room // CEILING[k]):
                pattern[int(k)] = m
                room -= m * CEILING[k]
        use(min(int(left[k]) // m for k, m in pattern.items()), pattern)
    return out


def pack(cut: DataFrame) -> DataFrame:
    """Add sequence_id and offset to ``pieces``; every piece in one sequence.

    The rank of a piece within its length class is its number in its task plus
    the count of the class in earlier tasks; a class may hold any share of the
    pieces. The plan gives each class runs of ranks per pattern.
    """
    cut = stored(cut, "pieces")
    by_task = stored(cut.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n")), "pieces-count")
    counts = {r["class"]: r["n"] for r in by_task.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    runs: dict[int, list[tuple[int, int, int]]] = {k: [] for k in counts}
    first, sequence = dict.fromkeys(counts, 0), 0
    for repeats, pattern in plan(counts):
        for k, m in pattern.items():
            runs[k].append((first[k], m, sequence))
            first[k] += repeats * m
        sequence += repeats
    before = F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = cut.join(by_task.select("part", "class", before.alias("before")), ["part", "class"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("at")).drop("before", "part", "at")
    tables = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in runs.items()}
    other = [f for f in ranked.schema if f.name not in ("class", "rank")]

    def place(batches):
        for b in batches:
            k, rank = b.column("class").to_numpy(), b.column("rank").to_numpy()
            out = np.empty(len(k), np.int64)
            for c in np.unique(k):
                starts, many, base = tables[int(c)]
                at = k == c
                run = np.searchsorted(starts, rank[at], "right") - 1
                out[at] = base[run] + (rank[at] - starts[run]) // many[run]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "sequence_id"])

    placed = map_arrow(ranked, place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema) + ", sequence_id long")
    within = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*[f.name for f in other], "sequence_id", F.coalesce(F.sum("length").over(within), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, with_ids: bool = False, table_words: int = TABLE_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``table_words`` bounds the words a worker keeps with their ids; fewer take
    less memory and more time, for the same rows.

    Cases: a null or empty text is the end id alone; a null doc_id, ties and
    repeated rows are packed like others; a text of any length is packed
    whole; an empty table gives no rows; other columns are not read.
    """
    return pack(pieces(docs, tokenizer, with_ids, table_words))


@query("op7_packing")
def op7_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
