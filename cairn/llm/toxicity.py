"""Toxicity with noisy-channel deobfuscation.

A character language model is counted over the whole corpus. Words that look
disguised (leet signs among letters, letters spaced or dotted apart, letters
repeated) form a lattice of readings, and a Viterbi search picks the likeliest
one under that model. The restored words are scored by the ratio of two
character models, of toxic and of other labelled texts, and a document by a
logistic regression over a few sums of its words' ratios.

Characters are folded to 28 classes, so each model is a table of 28 ** 4
counts at most: its size does not grow with the corpus, its counts do.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import map_arrow, stored
from cairn.llm.registry import query
from cairn.session import load

#: Most labelled rows that the classifier is fitted on.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
#: Character classes: 0 is the edge of a word, 1 to 26 letters, 27 any other.
CLASSES, ORDER = 28, 4
#: Signs read as letters.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
#: Log costs of the channel: a sign for a letter, a letter written again, a
#: separator inside a word, a sign that stands for itself.
SIGN, AGAIN, BETWEEN, ITSELF = -0.5, -0.7, -0.3, -9.0
#: Readings kept per place of a lattice; words remembered.
BEAM, TABLE_WORDS = 48, 250_000
#: Letters of a window over a longer word, and characters of a window that is
#: decoded: windows overlap by half, so that a word half as long lies whole in one.
LONGEST, DECODED = 40, 24
#: Stems that a task holds before it hands them on, and texts scored at once.
STEM_ROWS, BATCH = 150_000, 250
#: Share of the lower order in each order's estimate.
BACKOFF = 0.3
#: Log ratio from which a word counts as marked.
MARKED = 4.0
#: Word beginnings of these lengths are marked too, if at least STEM_DOCS toxic
#: training texts have them, and STEM_RATIO times as often. They come from the
#: bounded training rows alone.
STEM_LENGTHS, STEM_DOCS, STEM_RATIO = range(4, 9), 6, 12.0

_WORD = re.compile(r"[^\W\d_]+")
_THRICE = re.compile(r"([^\W\d_])\1\1+")
#: a sign before a letter, or one or two that end a word
_SIGNED = re.compile(r"[0-9@$!|+€][a-z]|[a-z][0-9@$€]{1,2}(?![\w@$!|+€])")
_DISGUISED = re.compile(r"[a-z0-9@$!|+€.\-_*]{3,}")
#: single characters apart: "i d i o t", "i.d.i.o.t"
_SPACED = re.compile(r"(?<![\w@$!|+€])[a-z0-9@$!|+€](?:[ .\-_*]{1,2}[a-z0-9@$!|+€]){3,}(?![\w@$|+€])")
_BETWEEN = set(" .-_*")


def windows(word: str, size: int) -> list[str]:
    """A word, or windows of ``size`` over a longer one, overlapping by half."""
    if len(word) <= size:
        return [word]
    return [word[at:at + size] for at in range(0, len(word) - size // 2, size // 2)]


def _class_table() -> np.ndarray:
    table = np.full(0x3000, 27, np.uint8)
    for c in range(len(table)):
        ch = chr(c).lower()
        base = unicodedata.normalize("NFKD", ch)[:1]
        if "a" <= base <= "z":
            table[c] = ord(base) - 96
        elif not ch.isalnum() or ch.isdecimal():
            table[c] = 0
    return table


_TABLE = _class_table()


def classes(text: str) -> np.ndarray:
    """Class of every character of a text, edges first and last."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.full(len(c) + 2, 0, np.uint8)
    own[1:-1] = np.where(c < len(_TABLE), _TABLE[np.minimum(c, len(_TABLE) - 1)], 27)
    return own


def gram_counts(text: str) -> np.ndarray:
    """Numbers of the windows of ORDER classes that end in a letter or its word's end."""
    c = classes(text)
    # one edge between words; a word starts from edges alone
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    edge = np.flatnonzero(c == 0)
    last = np.maximum.accumulate(np.where(c == 0, np.arange(len(c)), 0))
    at = np.arange(1, len(c))
    number = c[at].astype(np.int64)
    for k in range(1, ORDER):
        # characters before the word's start are edges; a closing edge looks back into its word
        from_ = at - k
        start = np.where(c[at] == 0, last[at - 1], last[at])
        number += np.where(from_ > start, c[np.maximum(from_, 0)], 0).astype(np.int64) * CLASSES ** k
    return number if len(edge) else number[:0]


class CharModel:
    """Interpolated probabilities of a character after ORDER - 1 others."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape([CLASSES] * ORDER).astype(np.float64)
        p = np.full(CLASSES, 1 / CLASSES)
        for order in range(1, ORDER + 1):
            own = c.sum(axis=tuple(range(ORDER - order)))
            total = own.sum(axis=-1, keepdims=True)
            # a context counts the less the rarer it is
            trust = (1 - BACKOFF) * total / (total + 5)
            p = trust * own / np.maximum(total, 1) + (1 - trust) * p
        self.log = np.log(p).ravel()


def decode(seen: str, model: CharModel) -> str:
    """The likeliest reading of a disguised word, as letters a to z."""
    wrap = CLASSES ** (ORDER - 1)
    #: (last classes, last letter, whether it was repeated) to (log p, letters)
    states = {(0, ""): (0.0, "")}
    for ch in seen:
        fold = unicodedata.normalize("NFKD", ch)[:1]
        letter = "a" <= fold <= "z"
        reads = [(fold, 0.0)] if letter else [(x, SIGN) for x in LEET.get(ch, "")]
        after: dict = {}

        def offer(key, p, said):
            if key not in after or p > after[key][0]:
                after[key] = (p, said)

        for (state, last), (p, said) in states.items():
            for x, cost in reads:
                k = ord(x) - 96
                offer(((state * CLASSES + k) % wrap, x), p + cost + model.log[state * CLASSES + k], said + x)
                if x == last:
                    offer((state, last), p + cost + AGAIN, said)
            if not letter:
                offer((state, last), p + (BETWEEN if ch in _BETWEEN else ITSELF), said)
        states = dict(sorted(after.items(), key=lambda s: -s[1][0])[:BEAM])
    return max(((p + model.log[state * CLASSES], said) for (state, _), (p, said) in states.items()), default=(0, ""))[1]


class Scorer:
    """Sums over a text's words, plain and restored."""

    def __init__(self, corpus: np.ndarray, other: np.ndarray, toxic: np.ndarray, stems: set[str]):
        self.corpus = CharModel(corpus)
        self.log_ratio = CharModel(toxic).log - CharModel(other).log
        self.stems = stems
        self.table: dict[str, float] = {}
        self.read: dict[str, str] = {}
        self.thrice: set[str] = set()

    def learn(self, counts: list) -> None:
        """Adds the ratios of words that are new to the table, all at once."""
        words = [w for w in set().union(*counts) if w not in self.table]
        if words:
            # a long word is as marked as the most marked of its windows
            parts = [windows(w, LONGEST) for w in words]
            flat = [x for own in parts for x in own]
            numbers = gram_counts("\n".join(flat))
            ends = np.cumsum([len(x) + 1 for x in flat])
            sums = np.add.reduceat(self.log_ratio[numbers], np.concatenate([[0], ends[:-1]])).tolist()
            at = 0
            for w, own in zip(words, parts, strict=True):
                r = max(sums[at:at + len(own)])
                at += len(own)
                stem = any(x[:k] in self.stems for x in own for k in STEM_LENGTHS if k <= len(x))
                self.table[w] = max(r, MARKED) if stem else r
            self.thrice.update(w for w in words if _THRICE.search(w))

    def read_as(self, seen: str) -> str:
        if seen not in self.read:
            if len(self.read) >= TABLE_WORDS // 10:
                self.read.clear()
            self.read[seen] = decode(seen, self.corpus)
        return self.read[seen]

    def restored(self, text: str, words) -> set[str]:
        """Readings of the disguised words of a lower-case text; a long one is
        read window by window, letters written more than twice count as two."""
        seen = self.thrice & words
        seen.update(m.group() for m in _SPACED.finditer(text))
        if _SIGNED.search(text):
            for part in set(text.split()):
                part = part.strip(",.;:?!\"'()[]")
                if _SIGNED.search(part) and _DISGUISED.fullmatch(part) and 3 * sum(map(str.isalpha, part)) >= len(part):
                    seen.add(part)
        parts = {x for s in seen for x in windows(_THRICE.sub(r"\1\1", s) if len(s) > DECODED else s, 2 * DECODED if s[1:2] in _BETWEEN else DECODED)}
        return {r for r in map(self.read_as, parts) if len(r) > 2}

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Rows (mean ratio, log share of marked words, log sum of marked
        ratios, largest ratio, log sum of restored marks)."""
        low = [t.lower() for t in texts]
        counts = [Counter(_WORD.findall(t)) for t in low]
        if len(self.table) > TABLE_WORDS:
            self.table.clear()
            self.thrice.clear()
        self.learn(counts)
        again = [self.restored(t, c.keys()) - c.keys() for t, c in zip(low, counts, strict=True)]
        self.learn(again)
        out = np.zeros((len(texts), 5))
        ratio = self.table.__getitem__
        for row, own, more in zip(out, counts, again, strict=True):
            n = sum(own.values())
            if not n and not more:
                continue
            r, k = np.fromiter(map(ratio, own), float, len(own)), np.fromiter(own.values(), float, len(own))
            h = np.fromiter(map(ratio, more), float, len(more))
            marked, h = r >= MARKED, h[h >= MARKED]
            row[:] = ((r * k).sum() / max(n, 1), math.log1p(1000 * ((k * marked).sum() + len(h)) / max(n, 1)),
                      math.log1p(r[marked].sum() + h.sum()), max(r.max(initial=0), h.max(initial=0)), math.log1p(h.sum()))
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (intercept first), means and scales, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), ridge * np.eye(z.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def _held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted).

    The classifier sees at most ``train_rows`` labelled rows, those with the
    smallest hash of doc_id among the rows not held out; the language model
    counts every document. Cases: a null, empty or wordless text gets the
    score of a text without marks; a null doc_id is scored and not held out;
    repeated rows and ties score alike; rows of ``labels`` with a null label
    or doc_id are ignored, and several labels of one document count as toxic
    if any is; without labels of both kinds every score is the share of toxic
    labels (0 without labels); an empty table gives no rows. Texts are read
    whole; other columns are not read.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select(
        F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    # at most train_rows rows of two numbers; equal texts count once
    picked = docs.select("doc_id", F.xxhash64("text").alias("h")).join(F.broadcast(stored(picked, "toxic-labels")), F.col("doc_id") == F.col("labelled"))
    picked = picked.groupBy("h").agg(F.min(F.struct("labelled", "toxic")).alias("r")).select("r.*").dropDuplicates(["labelled"])
    picked = stored(picked, "toxic-train")
    texts = docs.select("doc_id", "text")
    marked = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("labelled"), "left").select("text", "toxic")
    size = CLASSES ** ORDER

    def count(batches):
        counts = np.zeros((3, size), np.int64)
        for b in batches:
            kind = [0 if t is None else 1 + bool(t) for t in b.column("toxic").to_pylist()]
            whole: list[list[str]] = [[], [], []]
            for k, t in zip(kind, b.column("text").to_pylist(), strict=True):
                whole[k].append(t or "")
            for k, own in enumerate(whole):
                part, held = [], 0
                for t in [*own, None]:
                    if t is not None:
                        part.append(t)
                        held += len(t)
                    if part and (t is None or held > 500_000):
                        counts[k] += np.bincount(gram_counts("\n".join(part)), minlength=size)
                        part, held = [], 0
        kind, gram = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(gram.astype(np.int32)), pa.array(counts[kind, gram])], ["kind", "gram", "n"])

    grams = map_arrow(marked, count, "kind int, gram int, n long").groupBy("kind", "gram").agg(F.sum("n").alias("n"))
    # at most 3 * 28 ** 4 rows, whatever the corpus
    found = grams.toArrow()
    counts = np.zeros((3, size), np.int64)
    counts[found.column("kind").to_numpy(), found.column("gram").to_numpy()] = found.column("n").to_numpy()

    def stems(batches):
        # stem to [tokens, texts] by class; handed on before it grows large
        held: tuple[dict, dict] = ({}, {})

        def rows():
            for toxic, own in enumerate(held):
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()),
                         pa.array([n for n, _ in own.values()], pa.int64()), pa.array([d for _, d in own.values()], pa.int64())],
                        ["stem", "toxic", "n", "docs"])
                    own.clear()

        for b in batches:
            for t, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                own: dict = {}
                for w, n in Counter(_WORD.findall((t or "").lower())).items():
                    for k in STEM_LENGTHS:
                        if k <= len(w):
                            own[w[:k]] = own.get(w[:k], 0) + n
                table = held[bool(toxic)]
                for x, n in own.items():
                    n0, d0 = table.get(x, (0, 0))
                    table[x] = (n0 + n, d0 + 1)
                if len(held[0]) + len(held[1]) > STEM_ROWS:
                    yield from rows()
        yield from rows()

    seen = map_arrow(marked.where("toxic IS NOT NULL"), stems, "stem string, toxic int, n long, docs long")
    kind = lambda c, y: F.sum(F.when(F.col("toxic") == y, F.col(c)).otherwise(0))
    seen = seen.groupBy("stem").agg(kind("n", 1).alias("n1"), kind("n", 0).alias("n0"), kind("docs", 1).alias("d1"))
    total = counts.reshape(3, -1, CLASSES)[:, :, 0].sum(1)  # words: closing edges
    odds = (F.col("n1") / F.lit(float(max(total[2], 1)))) / ((F.col("n0") + 1) / F.lit(float(max(total[1], 1))))
    strong = seen.where(F.col("d1") >= STEM_DOCS).withColumn("odds", odds).where(F.col("odds") >= STEM_RATIO)
    strong = {r["stem"] for r in strong.select("stem").collect()}
    model = docs.sparkSession.sparkContext.broadcast((counts.sum(0), counts[1], counts[2], strong))

    def measure(batches):
        scorer = Scorer(*model.value)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            x = np.concatenate([np.zeros((0, 5)), *[scorer(texts[at:at + BATCH]) for at in range(0, len(texts), BATCH)]])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *[pa.array(x[:, k]) for k in range(5)]], ["doc_id", "x0", "x1", "x2", "x3", "x4"])

    sums = stored(map_arrow(texts, measure, "doc_id long, x0 double, x1 double, x2 double, x3 double, x4 double"), "toxic-sums")
    train = sums.join(F.broadcast(picked), F.col("doc_id") == F.col("labelled")).select("toxic", "x0", "x1", "x2", "x3", "x4", "doc_id")
    # rows that repeat a doc_id may exceed the bound: one of each stays
    train = train.groupBy("doc_id").agg(F.min(F.struct("toxic", "x0", "x1", "x2", "x3", "x4")).alias("r")).orderBy("doc_id").select("r.*").toPandas()
    y = (train["toxic"].to_numpy() != 0).astype(float)
    if 0 < y.sum() < len(y):
        x = train[["x0", "x1", "x2", "x3", "x4"]].to_numpy()
        w, mean, scale = fit_logistic(x, y)
        if w[5] < 0:
            # a disguise never speaks against toxicity: keys that read like words
            # in a few clean texts would otherwise turn its sign
            w, mean, scale = fit_logistic(x[:, :4], y)
            w, mean, scale = np.append(w, 0.0), np.append(mean, 0.0), np.append(scale, 1.0)
    else:
        rate = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        w, mean, scale = np.array([math.log(rate / (1 - rate)), 0, 0, 0, 0, 0.0]), np.zeros(5), np.ones(5)
    margin = F.lit(float(w[0]))
    for k in range(5):
        margin = margin + (F.col(f"x{k}") - F.lit(float(mean[k]))) * F.lit(float(w[k + 1] / scale[k]))
    value = 1 / (1 + F.exp(-margin))
    return sums.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), value.alias("score"),
                       (value >= THRESHOLD).cast("int").alias("predicted"))


def held_out(doc_id) -> bool:
    """The fold rule, for a Python value."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    """Scores of all documents."""
    return score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
