"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model continues over a white-space marker or a line feed, so
a text falls into chunks (a run of markers and what follows, or a line feed
and what follows) that are segmented independently. Each task keeps a table of
distinct chunks: a chunk is segmented once, and the ids are joined back by
position. Words repeat so often (135 million positions, 4 million words in
0.8 GB of text) that a shuffle of positions would cost many times the
segmentation it saves; the table is therefore local to a task and bounded.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm.common import map_arrow
from cairn.llm.registry import query
from cairn.session import load

#: Chunks a task's table holds before it starts a new one.
TABLE_CHUNKS = 400_000
MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")


class Codec:
    """Encodes texts exactly as the library does on whole texts."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        #: pieces must not cross a marker, and the model must not drop or fold
        #: white space; else whole texts are encoded
        self.by_chunk = (not any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in pieces)
                         and self.model.encode("a  b ", out_type=str)[-1] == MARK
                         and self.model.encode("\n")[0] == self.model.piece_to_id(MARK))
        self.table: dict[str, bytes] = {}

    def _segment(self, chunks: list[str]) -> None:
        """Adds chunks to the table, in one call of the library."""
        mark = self.model.piece_to_id(MARK)
        # the library puts a marker before what it encodes: one is taken off a
        # run of markers, or is dropped again before a line feed
        ids = self.model.encode([c if c[0] == "\n" else c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        for c, own in zip(chunks, ids, strict=True):
            own = own[1:] if c[0] == "\n" else own or [mark]
            self.table[c] = np.array(own, dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.array(x, dtype="<i4") for x in self.model.encode(texts, num_threads=1)]
        split = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        out = []
        for chunks in split:
            try:
                ids = b"".join([self.table[c] for c in chunks])
            except KeyError:
                distinct = dict.fromkeys(chunks)
                fresh = [c for c in distinct if c not in self.table]
                if len(self.table) + len(fresh) > TABLE_CHUNKS:
                    # a new table takes all of this text's chunks, however many
                    self.table.clear()
                    fresh = list(distinct)
                self._segment(fresh)
                ids = b"".join([self.table[c] for c in chunks])
            out.append(np.frombuffer(ids, dtype="<i4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


@functools.lru_cache(maxsize=2)
def _codec(model: str) -> Codec:
    return Codec(model)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Rows (doc_id, ids array<int>); narrow, without a shuffle.

    Cases: a null or empty text has no ids; a null doc_id, ties and repeated
    rows keep one row each; texts are encoded whole; an empty table gives no
    rows; other columns are not read.
    """

    def run(batches):
        codec = _codec(model)
        for b in batches:
            ids = codec.encode([t or "" for t in b.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate([*ids, np.empty(0, "<i4")]))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), lists], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, model: str) -> DataFrame:
    """Rows (doc_id, text) from (doc_id, ids); null ids decode to an empty text."""

    def run(batches):
        codec = _codec(model)
        for b in batches:
            texts = [codec.model.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(ids.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding."""

    def run(batches):
        codec = _codec(model)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in batches:
            ids = codec.encode([t or "" for t in b.column("text").to_pylist()])
            lists = [x.tolist() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([sha(str(x)[1:-1].replace(" ", "").encode()) for x in lists], pa.string()),
                 pa.array([sha(codec.model.decode(x).encode()) for x in lists], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select("doc_id", "text"), run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op6_piece_codec")
def op6_piece_codec(spark, sf_dir):
    """Every whole text encoded and decoded."""
    import public_tokenizers

    return digests(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
