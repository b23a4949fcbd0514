"""The corpus pipeline: rules, line dedup, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.llm import line_dedup, minhash_dedup, packing, quality_rules, secret_scan
from cairn.llm.common import stored
from cairn.session import load

#: Words with their ids that a worker keeps in packing: the executors hold what
#: the stages before have grown to, so less is left than to op7_packing alone.
PACK_WORDS = 200_000


def quality(spark, docs, sf_dir):
    """Documents that pass every rule of the production policy.

    Cases: a null, empty or blank text has too few words and goes; a null
    doc_id, ties and repeated rows are judged row by row; a text of any length
    is measured whole; an empty table gives no rows; all columns stay, whatever
    their names.
    """
    return quality_rules.keep_documents(docs)


def lines(spark, docs, sf_dir):
    """Texts without lines that repeat or nearly repeat an earlier one.

    Cases: null and empty texts stay as they are; a document that loses its
    last word goes; repeated rows are one document and end up alike; ties go
    by doc_id (null first), then by text; lines of any length are compared
    whole; an empty table gives no rows; all columns stay.
    """
    return line_dedup.dedup_lines(docs)


def near(spark, docs, sf_dir):
    """One document of each group of near-duplicates: five-word shingles,
    similarity of 0.8 or more.

    Cases: of rows with one doc_id, one stays (texts are compared by doc_id,
    so they can't be told apart); rows with a null doc_id stay, all of them;
    a document without words is like no other; of a group the smallest doc_id
    stays; an empty table gives no rows; all columns stay, whatever their names.
    """
    judged = minhash_dedup.near_duplicates(docs, shingle=5, percent=80)
    gone = judged.where(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_gone")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = whole.join(gone, F.col("_row.doc_id") == F.col("_gone"), "left_anti")
    # only the rows of repeated doc_ids are shuffled for it, reduced in every task first
    again = whole.select(F.col("_row.doc_id").alias("_id")).where("_id IS NOT NULL").groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")
    repeated = F.col("_row.doc_id") == F.col("_id")
    one = kept.join(again, repeated, "left_semi").groupBy(F.col("_row.doc_id")).agg(
        F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")).select("_row")
    return kept.join(again, repeated, "left_anti").unionByName(one).select("_row.*")


def secrets(spark, docs, sf_dir):
    """Texts with every secret replaced by a mark.

    Cases: null and empty texts stay; repeated rows end up alike; texts of any
    length are scanned whole; an empty table gives no rows; all rows and
    columns stay.
    """
    return secret_scan.redact(docs)


def pack(spark, docs, sf_dir):
    """The pieces of all documents, in sequences of at most 2048 tokens.

    Cases: a null or empty text is one piece, the end id; a null doc_id and
    repeated rows are packed like others; a text of any length is cut at whole
    windows; an empty table gives no rows; other columns are not read.
    """
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), table_words=PACK_WORDS)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_near_dedup", near), ("secret_scan", secrets), ("packing", pack)]

#: Signatures, tokens and packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
