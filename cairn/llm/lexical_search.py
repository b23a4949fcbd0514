"""Ranked lexical search, term at a time with a limit on accumulators.

Statistics come from one pass over the documents: each task counts, per term,
the documents that hold it, and the counts of the query terms are summed. The
search is a second pass. A task keeps the postings of the query terms for a
stretch of its documents and scores each item against them, rarest term first.
A document met for the first time gets an accumulator, until the bounds of the
terms to come (the largest addition each can make in the stretch) add up to
less than the k-th best partial score; from then on only the documents that
have an accumulator are updated, and these exactly. Best scores of earlier
stretches of the task raise the bar, as no document below them can come back.

Each task hands on at most k documents per item, so what is shuffled does not
grow with the postings of a frequent term. Items travel to the tasks in blocks
of bounded size, one search pass a block; texts are never shuffled or stored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import map_arrow, stored
from cairn.llm.registry import query
from cairn.session import load

K = 20
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: (item, term) rows that a block of items may hold; one item is never parted.
BLOCK_TERMS = 500_000
#: Postings that a task scores together, and documents that it takes at most for them.
STRETCH, STRETCH_DOCS = 2_000_000, 50_000
#: Lists that an item's candidates are dealt over before the last ranking.
SPREAD = 64
_UPPER = re.compile("[A-Z]+")


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, A-Z lower-cased, with repeats."""
    if not text:
        return []
    if text.isascii():
        return TERM.findall(text.lower())
    return TERM.findall(_UPPER.sub(lambda m: m[0].lower(), text))


def _count(batches):
    """Per batch: documents with each term, and in a row without term the documents that hold any and all terms with repeats."""
    for b in batches:
        held, n, total = Counter(), 0, 0
        for t in b.column("text"):
            found = terms_of(t.as_py())
            held.update(set(found))
            n += bool(found)
            total += len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *held], pa.string()), pa.array([n, *held.values()], pa.int64()), pa.array([total] + [0] * len(held), pa.int64())],
            ["term", "docs", "terms"])


def item_terms(items: DataFrame) -> DataFrame:
    """Rows (item, item_id, term, repeats), ``item`` numbering the rows of ``items``."""

    def run(batches):
        for b in batches:
            out = [(i, d, t, n) for i, d, x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) for t, n in Counter(terms_of(x)).items()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "item_id", "term", "repeats"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return map_arrow(rows, run, "item long, item_id long, term string, repeats long")


def weighted(docs: DataFrame, asked: DataFrame) -> tuple[DataFrame, int, int]:
    """``asked`` with the weight and df of each term that documents hold, and the corpus figures N and L."""
    counts = stored(map_arrow(docs.select("text"), _count, "term string, docs long, terms long")
                    .groupBy("term").agg(F.sum("docs").alias("df"), F.sum("terms").alias("terms")), "search-terms")
    whole = counts.where("term IS NULL").first()
    n, total = (whole["df"], whole["terms"]) if whole else (0, 0)
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    return asked.join(counts.select("term", "df", w.alias("w")), "term"), n, total


class Block:
    """The terms of some items, rarest first."""

    def __init__(self, rows: list[tuple]):
        """Rows (item, item_id, term, repeats, df, w)."""
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(r[2] for r in rows))}
        self.ids = {r[0]: r[1] for r in rows}
        plan: dict[int, list] = {}
        for item, _, term, repeats, df, w in rows:
            if w * repeats:
                plan.setdefault(item, []).append((df, term, repeats * w))
        self.plan = {i: [(self.terms[t], w) for _, t, w in sorted(own)] for i, own in plan.items()}


class Stretch:
    """Postings of a block's terms for some documents."""

    def __init__(self, block: Block, n_docs: int, total: int):
        self.block, self.n_docs, self.total = block, n_docs, total
        self.clear()

    def clear(self) -> None:
        self.doc_ids, self.lengths = [], []
        self.doc, self.term, self.tf = [], [], []

    def add(self, doc_id, text) -> None:
        found = terms_of(text)
        known = self.block.terms
        own = Counter([known[t] for t in found if t in known])
        if own:
            self.doc.extend([len(self.doc_ids)] * len(own))
            self.term.extend(own)
            self.tf.extend(own.values())
            self.doc_ids.append(doc_id)
            self.lengths.append(len(found))

    def full(self) -> bool:
        return len(self.doc) >= STRETCH or len(self.doc_ids) >= STRETCH_DOCS

    def search(self, k: int, best: dict) -> None:
        """Merges the k best documents of each item into ``best``: item to (scores, doc ids), best first."""
        if not self.doc_ids:
            return
        doc, term, tf = (np.array(x, np.int64) for x in (self.doc, self.term, self.tf))
        m = 75 + (25 * np.array(self.lengths, np.int64) * self.n_docs) // self.total
        gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.argsort(term, kind="stable")
        doc, gain, term = doc[order], gain[order], term[order]
        cut = np.searchsorted(term, np.arange(len(self.block.terms) + 1))
        most = np.zeros(len(self.block.terms), np.int64)
        held = np.flatnonzero(np.diff(cut))
        most[held] = np.maximum.reduceat(gain, cut[held])
        # a null id comes after all others
        ids = np.array([np.iinfo(np.int64).max if i is None else i for i in self.doc_ids], np.int64)
        null = np.array([i is None for i in self.doc_ids])
        for item, plan in self.block.plan.items():
            plan = [(t, w) for t, w in plan if most[t]]
            if not plan:
                continue
            have = best.get(item)
            bar = int(have[0][k - 1]) if have and len(have[0]) >= k else 0
            score = accumulate([(doc[cut[t]:cut[t + 1]], gain[cut[t]:cut[t + 1]] * w, int(most[t]) * w) for t, w in plan], len(ids), k, bar)
            found = np.flatnonzero(score > 0)
            if have:
                found = found[score[found] >= bar]
                s = np.append(have[0], score[found])
                i, z = np.append(have[1], ids[found]), np.append(have[2], null[found])
            else:
                s, i, z = score[found], ids[found], null[found]
            top = np.lexsort((i, z, -s))[:k]
            best[item] = (s[top], i[top], z[top])


def accumulate(lists: list, n: int, k: int, bar: int) -> np.ndarray:
    """Scores of n documents over ``lists`` of (documents, additions, bound), rarest first.

    A document that cannot be among the k best (whose k-th reaches ``bar``
    already) may be left at 0; all others have their exact score.
    """
    score = np.zeros(n, np.int64)
    left = sum(bound for *_, bound in lists)
    closed = None
    for doc, add, bound in lists:
        if closed is None and left < max(bar, int(score.max())):
            # new documents stay below bar only if strictly less is left than the k-th partial score
            held = score[score > 0]
            kth = int(np.partition(held, len(held) - k)[len(held) - k]) if len(held) >= k else 0
            if left < max(bar, kth):
                closed = score > 0
        if closed is not None:
            known = closed[doc]
            doc, add = doc[known], add[known]
        score[doc] += add
        left -= bound
    return score


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score.

    Every row of ``docs`` is a document and every row of ``items`` an item.
    Cases: a null, empty or term-less text is a document that holds nothing,
    and an item without terms has no rows; items whose terms no document
    holds have none either; ties go to the lower doc_id, a null one last;
    repeated rows are ranked side by side, repeated items each get their rows;
    a text of any length counts whole; empty tables give no rows; other
    columns are not read, so their names can't clash.
    """
    asked, n, total = weighted(docs, stored(item_terms(items), "search-items"))
    asked = stored(asked, "search-weights")
    found = None
    blocks = -(-2 * asked.count() // BLOCK_TERMS)
    for b in range(blocks):
        # an item lies in one block; by their hash, blocks hold half the bound on average
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        rows = [tuple(r) for r in own.select("item", "item_id", "term", "repeats", "df", "w").collect()]
        part = _search_block(docs, Block(rows), n, total, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    spread = Window.partitionBy("item", "task").orderBy(*order)
    each = Window.partitionBy("item").orderBy(*order)
    found = found.withColumn("r", F.row_number().over(spread)).where(F.col("r") <= k)
    return found.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, block: Block, n: int, total: int, k: int) -> DataFrame:
    """Rows (item, item_id, doc_id, score, task): the k best of each item in each task."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        own = Stretch(shared.value, n, total)
        best: dict = {}
        for b in batches:
            for d, t in zip(b.column("doc_id"), b.column("text"), strict=True):
                own.add(d.as_py(), t.as_py())
                if own.full():
                    own.search(k, best)
                    own.clear()
        own.search(k, best)
        task = TaskContext.get().partitionId() % SPREAD
        rows = [(i, own.block.ids[i], None if z else d, s, task) for i, top in best.items() for s, d, z in zip(*(x.tolist() for x in top), strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score", "task"])

    return map_arrow(docs.select("doc_id", "text"), run, "item long, item_id long, doc_id long, score long, task long")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r
  FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term, r
  FROM (SELECT *, row_number() OVER () AS r FROM benchmark)),
c AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT doc_id, r, len(w) AS n, unnest(w) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT r, item_id, term, count(*) AS m FROM i GROUP BY ALL),
s AS (
  SELECT q.r, q.item_id, tf.doc_id, tf.r AS dr,
         CAST(sum(q.m * CAST(floor(1000 * ln((2.0::DOUBLE * c.nd + 2) / (2.0::DOUBLE * df.df + 1))) AS BIGINT)
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + ((25 * tf.n * c.nd) // c.l))))) AS BIGINT) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term), c GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""


@query("op11_lexical_search", SQL)
def op11_lexical_search(spark, sf_dir):
    """The 20 best documents of each benchmark item."""
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
