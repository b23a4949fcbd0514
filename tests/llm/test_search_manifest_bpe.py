"""Ranked search, the Merkle manifest and the BPE codec against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql.functions import col

from cairn.llm import bpe_codec, lexical_search, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, tree int, n int, pos int, term string"
EXTRA = ("x", "y", 1, 2, 3, "z")
VOCABULARY = [f"{a}{b}" for a in ("al", "be", "cor", "dü", "日") for b in ("ta", "ron", "7", "é")]


def texts(n, seed):
    r = random.Random(seed)
    return ["\n".join(" ".join(r.choices(VOCABULARY, [1 / (k + 1) for k in range(20)], k=r.randint(1, 30))).title() for _ in range(r.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    out = [(k, t, "en", "hot" if k % 3 else f"s{k % 7}", len(t)) for k, t in enumerate(texts(150, 1))]
    out += [(200, None, None, None, None), (201, "", "", "", 0), (202, " \n ", "en", None, 3), (203, "a\0b <|endoftext|> it's 🙂", "x", "é", 9),
            (204, "nothing else holds xylophone", "en", "alone", 1), (None, "al ta Alta", "en", "hot", 1), (None, None, None, None, None)]
    return [*out, out[5], out[5], (5, "alta", "en", "hot", 4), out[-3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, k):
    own = [(d, Counter(terms(t))) for d, t, *_ in rows]
    n, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in own:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            scores.append((-s, d is None, d or 0))
        out += [(item, r, None if z else d, -s) for r, (s, z, d) in enumerate([x for x in sorted(scores) if x[0] < 0][:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "alta BERON beron corta"), (2, None), (3, ""), (4, "!!"), (5, "unheardof"), (6, "xylophone al al ta"), (6, "dü7 日é dü7"), (None, "be7 alta"),
         (7, " ".join(VOCABULARY)), (8, "düta düron dü7")]


def test_search_matches_brute_force(spark, docs, rows, monkeypatch):
    items = spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id long, text string, term string, w int")
    for k, stretch, block in ((20, 2_000_000, 500_000), (3, 40, 500_000), (3, 40, 6)):
        monkeypatch.setattr(lexical_search, "STRETCH", stretch)
        monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
        got = lexical_search.search(docs, items, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == ranked(rows, ITEMS, k)
    assert lexical_search.search(docs.where("doc_id < -5"), items).count() == 0
    assert lexical_search.search(docs, items.where("item_id < -5")).count() == 0


def test_accumulators_close_and_survivors_stay_exact():
    r = np.random.default_rng(2)
    for k, bar in ((1, 0), (5, 0), (5, 300)):
        closed = 0
        for _ in range(200):
            lists = []
            for size in sorted(r.integers(1, 60, 8)):
                add = r.integers(1, 4000 // size, size)
                lists.append((r.permutation(60)[:size], add, int(add.max())))
            full = np.zeros(60, np.int64)
            for d, a, _ in lists:
                full[d] += a
            got = lexical_search.accumulate(lists, 60, k, bar)
            least = max(bar, np.sort(full)[-k])
            assert (got[full >= least] == full[full >= least]).all() and ((got == full) | (got == 0)).all()
            closed += (got != full).any()
        assert closed > 50


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, from whole trees."""

    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def way(levels, at):
        for nodes in levels[:-1]:
            lo = at // 3 * 3
            yield nodes[lo:at], nodes[at + 1:lo + 3]
            at //= 3

    def altered(row):
        even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return (row[0], row[1].replace("\n", "") if even and row[1] else row[1], *row[2:])

    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    root = top[-1][0]
    out = []
    for k, s in enumerate(names):
        for at, (_, _, own, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = [*way(trees[s], at), *way(top, k)]
            cur = leaf(altered(row))
            for left, right in steps:
                cur = digest(*left, cur, *right)
            out.append((row[0], own, trees[s][-1][0], root, digest(*(d for a, b in steps for d in a + b)), cur, cur == root))
    return sorted(out, key=repr)


def test_manifest_matches_whole_trees(docs, rows):
    got = merkle_manifest.verify(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)
    assert merkle_manifest.verify(docs.where("doc_id < -5")).count() == 0


@pytest.mark.parametrize("n", [1, 4, 10])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, f"a\n{k}", "en", "one" if k else "two", 1) for k in range(n)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    assert sorted(map(tuple, merkle_manifest.verify(df).collect()), key=repr) == manifest(rows)


def test_descent_opens_the_asked_paths_only(docs):
    m = merkle_manifest.build(docs)
    every = {(r["doc_id"], r["leaf"].hex()): r for r in merkle_manifest.proofs(m).collect()}
    some = merkle_manifest.proofs(m, m.leaves.where("doc_id IN (7, 60, 100)")).collect()
    assert len(some) == 3 and all(r == every[r["doc_id"], r["leaf"].hex()] for r in some)
    folded = merkle_manifest.proofs(m).select("leaf", merkle_manifest.folded(col("leaf"), col("segments")).alias("r"))
    assert folded.where(col("r") != m.root).count() == 0


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_codec_matches_the_library(docs, rows):
    path, tok = public_tokenizers.path("word_bpe_49k.json"), library()
    want = []
    for d, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe_codec.digests(docs, path).collect()), key=repr) == sorted(want, key=repr)
    back = {r["doc_id"]: r["text"] for r in bpe_codec.decode(bpe_codec.encode(docs, path), path).collect()}
    assert back[203] == tok.decode(tok.encode(rows[153][1], add_special_tokens=False).ids, skip_special_tokens=False) and back[200] == ""
    assert bpe_codec.digests(docs.where("doc_id < -5"), path).count() == 0


def test_codec_on_odd_strings(monkeypatch):
    monkeypatch.setattr(bpe_codec, "TABLE_WORDS", 300)  # a table that starts anew in between
    codec, tok, r = bpe_codec.Codec(public_tokenizers.path("word_bpe_49k.json")), library(), random.Random(3)
    parts = ["a", "aa", "aaaa", "haha", "é", "É", "ß", "ﬁ", "日", "🙂", "👍🏽", " ", "\n", "\t", "\x85", "\xa0", "\x1c", " ", "'s", "'S", "'ll", "<|endoftext|>",
             "<|startoftext|>", "<|", "|>", "1", "½", "Ⅷ", "_", "...", "\0", "Σ", "İ", "ſ", "K", "한", "ᄒ", "ᅡ", "ᆫ", "́", "‍", "﻿", "!!!"]
    for _ in range(40):
        own = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(50)]
        for t, ids in zip(own, codec.encode(own), strict=True):
            want = tok.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == want and codec.decode(want) == tok.decode(want, skip_special_tokens=False)
    long = "".join(r.choice("abehlou") for _ in range(60_000)) + " " + "a" * 50_001
    assert codec.encode([long])[0].tolist() == tok.encode(long, add_special_tokens=False).ids


def test_merges_out_of_order_are_refused():
    letters = bpe_codec.byte_letters()
    vocab = {t: k for k, t in enumerate([*letters, *(c + "</w>" for c in letters), "ab", "abc"])}
    with pytest.raises(ValueError):
        bpe_codec.Merges(vocab, ["ab c", "a b"], "</w>")
    assert [x.tolist() for x in bpe_codec.Merges(vocab, ["a b", "ab c"], "</w>").apply([b"abca", b"b"])] == [[vocab["abc"], vocab["a</w>"]], [vocab["b</w>"]]]
