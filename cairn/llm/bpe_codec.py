"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a stretch of a partition are laid end to end as one line
of symbols. An index maps every adjacent pair that has a merge rank to all its
positions in that line. The active ranks are taken in ascending order; a rank
is applied at all of its positions at once, and the lists of the pairs that
appear beside the merged symbols are extended. As no merge makes a pair of a
lower rank than its own (checked when the vocabulary is read), each word is
merged exactly as if it were alone, lowest rank first.

Texts never leave their task: there is no shuffle. What a word was merged to is
kept in a bounded table, so a later stretch indexes only the words new to it.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm.common import map_arrow
from cairn.llm.registry import query
from cairn.session import load

#: Characters of text whose new words are indexed together.
STRETCH = 8_000_000
#: Distinct words a task's table holds before it starts a new one.
TABLE_WORDS = 1_200_000
#: The tokenizer's split pattern with its classes spelled out for Latin-1.
_LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[A-Za-zªµºÀ-ÖØ-öø-ÿ]+|[0-9²³¹¼-¾]"
    "|[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼-¾]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: its own
    character where that is visible, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in shown}
    for b in range(256):
        letter.setdefault(b, chr(0x100 + len(letter) - len(shown)))
    return [letter[b] for b in range(256)]


class Merges:
    """The vocabulary's merges, and the index that applies them to many words."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.left, self.right = left, right
        rank_of = {int(m): r for r, m in enumerate(self.made)}
        if len(rank_of) < len(pairs) or any(
                rank_of.get(int(x), -1) > r for r in range(len(pairs)) for x in (left[r], right[r])):
            raise ValueError("a merge comes before the merge that makes its part: ranks can't be applied in ascending order")
        codes = left * self.width + right
        self.by_code = np.argsort(codes)
        self.codes = codes[self.by_code]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        code = a * self.width + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.by_code[at], -1)

    def apply(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (bytes, none empty)."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        sym[ends - 1] = self.final[flat[ends - 1]]
        n = len(sym)
        # neighbours of a symbol in its word; n stands for none, and holds no pair
        after = np.arange(1, n + 1)
        after[ends - 1] = n
        before = np.arange(-1, n - 1)
        before[ends - sizes] = n
        sym = np.append(sym, -self.width)
        after, before = np.append(after, n), np.append(before, n)

        first = np.flatnonzero(after[:n] < n)
        rank = self._ranks(sym[first], sym[after[first]])
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def extend(at: np.ndarray, rank: np.ndarray) -> None:
            """Adds positions to the lists of their pairs."""
            held = rank >= 0
            at, rank = at[held], rank[held]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, own in zip(rank[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
                if r in index:
                    index[r].append(own)
                else:
                    index[r] = [own]
                    heapq.heappush(active, r)

        extend(first, rank)
        while active:
            r = heapq.heappop(active)
            own = index.pop(r)
            at = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
            a, b, c = self.left[r], self.right[r], self.made[r]
            # positions whose symbols were merged meanwhile hold another pair
            at = at[(sym[at] == a) & (sym[after[at]] == b)]
            if a == b and len(at) > 1:
                at = self._apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            far, near = after[gone], before[at]
            sym[at], sym[gone] = c, -1
            after[at] = far
            before[far] = at
            before[n] = n
            extend(np.concatenate([near, at]), self._ranks(
                np.concatenate([sym[near], sym[at]]), np.concatenate([sym[at], sym[far]])))
        kept = np.flatnonzero(sym[:n] >= 0)
        return np.split(sym[kept], np.searchsorted(kept, ends[:-1]))

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of a pair of equal symbols in a run, every second position from the left."""
        linked = after[at[:-1]] == at[1:]
        run = np.flatnonzero(np.append(True, ~linked))
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        return at[place % 2 == 0]


class Codec:
    """Ids of texts and texts of ids, as the tokenizers library gives them for the file at ``path``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or spec["decoder"]:
            raise ValueError(f"{path}: not a plain BPE vocabulary without a decoder")
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in special.items()}
        longest = sorted(map(re.escape, special), key=len, reverse=True)
        self.split = re.compile("(" + "|".join(longest) + ")") if special else None
        both = model["vocab"] | special
        self.tokens = [""] * (max(both.values()) + 1)
        for t, i in both.items():
            self.tokens[i] = t
        self.from_letter = {c: b for b, c in enumerate(byte_letters())}
        #: ids of a part between blanks, and of a word
        self.parts: dict[str, bytes] = {}

    def _words(self, part: str) -> list:
        """Words of a part as bytes; a special token as the bytes of its id in a tuple."""
        if self.split and "<" in part and self.split.search(part):
            return [w for x in self.split.split(part) if x for w in ([(self.special[x],)] if x in self.special else self._words(x))]
        try:
            part.encode("latin-1")
        except UnicodeEncodeError:
            text = self.library.normalizer.normalize_str(part)
            return [bytes(map(self.from_letter.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [w.encode() for w in _LATIN.findall(part.lower())]

    def _learn(self, new: set[str]) -> None:
        """Adds parts to the table: their distinct words go through one index."""
        words = {p: self._words(p) for p in new}
        distinct = list({w for own in words.values() for w in own if isinstance(w, bytes)})
        ids = {w: x.astype("<u4").tobytes() for w, x in zip(distinct, self.merges.apply(distinct), strict=True)}
        for p, own in words.items():
            self.parts[p] = b"".join([ids[w] if isinstance(w, bytes) else w[0] for w in own])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text.

        The library drops white space and no word or special token spans it,
        so a text is cut at blanks and line feeds first.
        """
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.parts) > TABLE_WORDS:
            self.parts = {}
        if new := set().union(*split).difference(self.parts):
            self._learn(new)
        get = self.parts.__getitem__
        return [np.frombuffer(b"".join(map(get, own)), "<u4") for own in split]

    def decode(self, ids) -> str:
        """The tokens side by side, as a vocabulary without a decoder gives them."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def _stretches(column):
    """Texts of a column, in lists of about STRETCH characters; null is empty."""
    own, size = [], 0
    for t in column:
        t = t.as_py() or ""
        own.append(t)
        size += len(t)
        if size >= STRETCH:
            yield own
            own, size = [], 0
    yield own


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids array<int>); narrow, without a shuffle.

    Cases: a null, empty or blank text has no ids; a null doc_id, ties and
    repeated rows keep one row each; a text of any length is encoded whole
    (its distinct words at once); the strings of special tokens become their
    ids, as in the library; an empty table gives no rows; other columns are
    not read, so their names can't clash.
    """

    def run(batches):
        codec = _codec(path)
        for b in batches:
            ids = [x for own in _stretches(b.column("text")) for x in codec.encode(own)]
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate([*ids, np.empty(0, "<u4")]).astype("<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), lists], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, text) from (doc_id, ids); null ids decode to an empty text."""

    def run(batches):
        codec = _codec(path)
        for b in batches:
            texts = [codec.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(ids.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding; cases as in ``encode``."""

    def run(batches):
        codec = _codec(path)
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for b in batches:
            n, own, back = [], [], []
            for texts in _stretches(b.column("text")):
                for ids in codec.encode(texts):
                    n.append(len(ids))
                    own.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    back.append(hashlib.sha256(codec.decode(ids.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())], names)

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op13_bpe_codec")
def op13_bpe_codec(spark, sf_dir):
    """Every whole text encoded and decoded."""
    import public_tokenizers

    return digests(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
