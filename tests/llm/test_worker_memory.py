"""What a Python worker holds: batches in slices, and a table of words that the pipeline bounds."""

import pyarrow as pa
import public_tokenizers

from cairn.llm import common, packing


def test_batches_come_in_slices_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    texts = ["x" * n for n in (10, 900, 5000, 0, 300)] * 40
    batches = [pa.RecordBatch.from_pydict({"text": t}, schema=pa.schema([("text", pa.string())])) for t in (texts, [], ["one"], texts)]
    got = list(common.sliced(iter(batches)))
    assert [t for b in got for t in b.column("text").to_pylist()] == texts + ["one"] + texts
    # no slice has more rows than the bytes of the batch allow on average
    assert max(b.num_rows for b in got) <= max(1, 1000 * len(texts) // batches[0].nbytes)
    # a row is never cut, and an empty batch keeps its columns
    assert all(b.schema.names == ["text"] for b in got) and any(b.num_rows == 0 for b in got)


def test_few_table_words_give_the_same_rows(spark):
    docs = spark.createDataFrame([(i, " ".join(f"word{i * k} {k}, Naïve." for k in range(60))) for i in range(20)] + [(20, None), (None, "")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [sorted(packing.pieces(docs, path, table_words=n).drop("at", "part").collect(), key=repr) for n in (20, packing.TABLE_WORDS)]
    assert len(rows[0]) == 22 and rows[0] == rows[1]


def test_a_table_starts_anew_past_its_words():
    ids = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), table_words=50)
    for k in range(30):
        ids([f"alpha{k} beta{j}" for j in range(20)])
        assert len(ids.table) <= 50 + 60
