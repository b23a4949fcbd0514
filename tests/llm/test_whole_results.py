"""Whole results of operators and of the pipeline against plain versions, and
texts that are long or odd."""

import random
import re
import zlib
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from cairn.llm import hilbert_shards, line_dedup, secret_scan

from test_llm import plain_distance, words

BLANK = " \t\n\v\f\r"


def th(text):
    x = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return x - (1 << 64) if x >> 63 else x


def plain_removals(docs):
    """(doc_id, text) to (n_lines, n_links, removed), by comparing all lines."""
    where = {}
    for d, t in set(docs):
        for k, x in enumerate((t or "").split("\n")):
            if x.strip(BLANK):
                where.setdefault(x, []).append(((d is not None, d or 0), th(t), k, d, t))
    lines = sorted(where)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = set()
    long = [x for x in lines if len(x) >= 20]
    for i, x in enumerate(long):
        for y in long[:i]:
            n = max(len(x), len(y))
            if abs(len(x) - len(y)) <= 2 and (d := plain_distance(x, y)) <= 2 and 100 * (n - d) >= 80 * n:
                linked |= {x, y}
                parent[find(x)] = find(y)
    classes = {}
    for x in lines:
        classes.setdefault(find(x), []).extend(where[x])
    first = {c: min(p[:3] for p in places) for c, places in classes.items()}
    out = {}
    for d, t in set(docs):
        own = [(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(BLANK)]
        gone = [k for k, x in own if ((d is not None, d or 0), th(t), k) != first[find(x)]]
        out[d, t] = (len(own), sum(x in linked for _, x in own), gone)
    return out


def line_docs(n, seed):
    r = random.Random(seed)
    pool = [" ".join(words(r.randint(1, 9), k)) for k in range(25)] + ["短い行です", "这是一个在每个文档里都重复出现的很长的句子没有空格", "short line here", "}", "0123456789012345678"]
    docs = []
    for k in range(n):
        own = []
        for _ in range(r.randint(0, 7)):
            x = list(r.choice(pool))
            for _ in range(r.choice((0, 0, 0, 1, 2, 3))):
                at = r.randrange(len(x) + 1)
                x[at:at + 1] = r.choice(["", "z", "yz"])
            own.append("".join(x))
        docs.append((r.randint(0, n // 2) if r.random() < 0.9 else None, "\n".join(own) if r.random() < 0.95 else None))
    return [*docs, docs[0], docs[1], (3, " \n\t"), (4, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(spark, seed):
    docs = line_docs(70, seed)
    want = plain_removals(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["th"]): (r["n_lines"], r["n_links"], r["removed"]) for r in line_dedup.removals(df).collect()}
    assert got == {(d, th(t)): w for (d, t), w in want.items() if w[0]}
    assert sum(len(w[2]) for w in want.values()) > 50 and sum(w[1] for w in want.values()) > 20
    texts = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df, drop_emptied=False).collect())
    assert texts == Counter((d, t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[d, t][2])) for d, t in docs)


def test_shards_match_their_texts_and_prune(spark):
    r = random.Random(4)
    rows = [(k, None if k % 50 == 0 else "é" * r.randint(0, 3000), r.choice("abcd") + "x", "host" if r.random() < 0.3 else f"s{r.randint(10, 40)}") for k in range(4000)]
    rows += [rows[3], (None, "x", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = hilbert_shards.shard(df).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in got) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    by = {}
    for x in got:
        by.setdefault(x["shard"], []).append(x)
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(x["slot"] for x in own) == list(range(len(own))) for own in by.values())
    # shards whose range of a dimension covers a value: the rest is pruned
    meta = {d: (s or "", lg or "", size(t)) for d, t, lg, s in rows}
    ranges = {s: [(min(c), max(c)) for c in zip(*(meta[x["doc_id"]] for x in own))] for s, own in by.items()}
    for at, most in ((0, 14), (1, 14), (2, 14)):
        values = [m[at] for m in meta.values()]
        opened = sum(sum(lo <= v <= hi for lo, hi in (x[at] for x in ranges.values())) for v in values) / len(values)
        assert opened <= most, (at, opened)


LONG = {
    "dots": "see https://x.org " + "a." * 500_000, "letters": "g" * 1_000_000, "equals": "secret" + "=" * 1_000_000, "hex": "0f" * 500_000,
    "quotes": "token" + "\"'" * 500_000, "blanks": "password" + " " * 1_000_000, "word": "secret" * 170_000, "keys": "AKIA" * 250_000,
    "scheme": "a+.-" * 250_000 + "://x", "hosts": "a.b" * 300_000 + ".amazonaws.com"}


def test_secrets_in_very_long_texts(spark):
    df = spark.createDataFrame(list(enumerate(LONG.values())), "doc_id long, text string").repartition(5)
    spans = {list(LONG)[r["doc_id"]]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secret_scan.scan(df).collect()}
    assert spans["hex"] == [(2, 0, 1_000_000)] and spans["keys"] == [(1, 0, 1_000_000)]
    assert all(not spans[k] for k in ("dots", "letters", "quotes", "blanks", "word", "scheme", "hosts"))
    clean = {list(LONG)[r["doc_id"]]: r["text"] for r in secret_scan.redact(df).collect()}
    assert clean["hex"] == clean["keys"] == "[SECRET]" and clean["dots"] == LONG["dots"]


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_near_stage_keeps_one_row_of_each_group(spark):
    r = random.Random(6)
    rows = []
    for k in range(160):
        w = words(90, k // 4)
        for _ in range(r.choice((0, 0, 1, 2, 3, 9))):
            w[r.randrange(90)] = f"w{r.randrange(10 ** 6)}"
        rows.append((k, " ".join(w), "x", k))
    rows += [rows[5], rows[5], (7, "another text of doc 7", "y", 0), (None, rows[0][1], "x", 1), (None, None, "x", 1), (900, None, "x", 1), (901, "", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string, _row long").repartition(4)
    got = corpus_pipeline.near(spark, df, None)
    assert got.columns == df.columns
    got = got.collect()
    # of repeated doc_ids the stage compares all texts
    sets = {}
    for d, t, *_ in rows:
        if d is not None:
            sets.setdefault(d, []).append(shingles(t))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = 0
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                near += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert near >= 50
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(d for d in sets if find(d) == d)
    assert sum(r["doc_id"] is None for r in got) == 2


def plain_quality(rows):
    """The documents that the rules keep, by their SQL."""
    import duckdb

    from cairn.llm import quality_rules

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    kept = {d for (d,) in con.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    return [r for r in rows if r[0] in kept]


def plain_lines(rows):
    gone = plain_removals(rows)
    out = []
    for d, t in rows:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d, t][2])
        if not gone[d, t][2] or left.strip(BLANK):
            out.append((d, left))
    return out


def plain_near(rows):
    sets, parent = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                i, j = sorted((find(a), find(b)))
                parent[j] = i
    return [r for r in rows if find(r[0]) == r[0]]


def plain_redact(rows):
    secret = re.compile(r"""(?i:password|secret)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}|AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}""")
    return [(d, secret.sub("[SECRET]", t)) for d, t in rows]


def test_pipeline_matches_plain_stages(spark, tmp):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from cairn.llm.packing import WINDOW

    r = random.Random(21)
    shared = [" ".join(words(12, 900 + k)) for k in range(4)]
    rows = []
    for k in range(110):
        own = [" ".join(words(r.randint(9, 14), 10_000 + 40 * (k // 3) + j)) for j in range(r.randint(4, 9))]
        if k % 3 and r.random() < 0.7:  # a near copy of an earlier document
            own[r.randrange(len(own))] += f" extra{k}"
        if r.random() < 0.3:
            own.insert(r.randrange(len(own)), r.choice(shared))
        if r.random() < 0.2:
            own.append(r.choice(["password = abcd1234efgh", "AKIA" + "ABCDEFGHIJKLMNOP", "0123456789abcdef" * 3]) + f" note{k}")
        if k % 5 == 4:  # the words of the document before, in lines of another length, some changed
            w = rows[-1][1].split()
            w[r.randrange(len(w))] = f"new{k}"
            own = [" ".join(w[at:at + 7]) for at in range(0, len(w), 7)]
        rows.append((k, "\n".join(own)))
    rows += [(200, "too short"), (201, rows[4][1]), (202, "same same same " * 60)]
    text = [(d, t, "en", "s", len(t)) for d, t in rows]
    spark.createDataFrame(text, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp}/documents.parquet")
    want = rows
    counts = [len(want)]
    for stage in (plain_quality, plain_lines, plain_near, plain_redact):
        want = stage(want)
        counts.append(len(want))
    assert counts[0] > counts[1] and counts[2] > counts[3] and any("[SECRET]" in t for _, t in want)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = set()
    for d, t in want:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), WINDOW):
            pieces.add((d, at, len(ids[at:at + WINDOW]), zlib.crc32(ids[at:at + WINDOW].tobytes()), len(ids)))
    got = corpus_pipeline.run(spark, tmp).collect()
    assert sorted((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in got) == sorted(pieces)
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= WINDOW
