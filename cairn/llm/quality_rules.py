"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurements
and one failure bit per rule. A policy is a versioned set of bits, so a new
policy, or the effect of leaving a rule out, is a bitwise operation on the
ledger and never reads the texts again. DataFrame functions only; one narrow
pass, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import WHITE
from cairn.llm.registry import query
from cairn.session import load

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

#: Rule name to failure condition over the measures. The position is the bit.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 40 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("long_words", "word_chars > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("capitals", "100 * n_upper > 60 * word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]

#: Versioned policies: a document is rejected if it fails any rule in the mask.
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["duplicate_lines"],
    "v2": sum(BIT.values()),
}
PRODUCTION = "v2"


def _repeat_words(w: str) -> str:
    """SQL: words of array ``w`` inside a 3-word window that occurs twice or more."""
    windows = f"transform(sequence(1, size({w}) - 2), i -> struct(xxhash64({w}[i - 1], {w}[i], {w}[i + 1]) AS h, i AS i))"
    ordered = f"array_sort({windows})"
    # windows equal to a neighbour in hash order, back in text order
    twice = (f"transform(array({ordered}), s -> array_sort(transform(filter(s, (x, k) -> "
             "(k > 0 AND x.h = s[k - 1].h) OR (k + 1 < size(s) AND x.h = s[k + 1].h)), x -> x.i)))[0]")
    # each window adds its words up to the next repeated window
    return (f"CASE WHEN size({w}) < 3 THEN 0L ELSE transform(array({twice}), p -> aggregate("
            "transform(p, (x, k) -> CASE WHEN k + 1 < size(p) THEN least(3, p[k + 1] - x) ELSE 3 END), "
            "0L, (a, x) -> a + x))[0] END")


def _without(text: str, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measures, fail_bits.

    Cases: a null text counts as empty; an empty or blank text has zero
    measures (and fails ``few_words``); a null doc_id and repeated rows stay,
    one row each; very long texts are measured whole (sorting windows, not
    comparing pairs); an empty table gives no rows. Other columns of ``docs``
    are not read, so their names can't clash.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "t", F.array_remove(F.split("t", WHITE), "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("ln"))
    measures = (
        F.size("w").cast("long").alias("n_words"),
        _without("t", "\x20\x09\x0a\x0b\x0c\x0d").cast("long").alias("word_chars"),
        (F.length("t") - _without("t", SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words("w")).alias("n_repeat_words"),
        F.size("ln").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
    )
    # a generator of one row: filters on the ledger stay above it, so that no
    # measure is computed again for a condition
    d = d.select("doc_id", F.inline(F.array(F.struct(*measures))))
    bits = " + ".join(f"CASE WHEN {cond} THEN {BIT[name]}L ELSE 0L END" for name, cond in RULES)
    return d.select("*", F.expr(bits).alias("fail_bits"))


def apply_policy(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Add base_failed, kept and policy to a ledger; reads bits only."""
    return rows.select(
        "*",
        (F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"),
        (F.col("fail_bits").bitwiseAND(F.lit(BASE | POLICIES[policy])) == 0).alias("kept"),
        F.lit(policy).alias("policy"))


def ablations(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: n_failed, and n_only, the documents that only it rejects.

    The ledger is first reduced to counts per bit pattern (at most
    2 ** len(RULES) rows, combined map-side), then spread over the rules.
    """
    mask = POLICIES[policy]
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit")) for n, _ in RULES if BIT[n] & mask])
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_only"))


def keep_documents(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with all their columns."""
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text")
    judged = ledger(whole.select(F.col("row").alias("doc_id"), "text"))
    return apply_policy(judged, policy).where("kept").select("doc_id.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
win AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM d WHERE len(w) >= 3),
tri AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM win),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         len(ln) AS n_lines, length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_upper
  FROM d LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_upper > 60 * word_chars THEN 64 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, n_lines, n_upper, CAST(fail_bits AS BIGINT) AS fail_bits, 'v2' AS policy
FROM b
"""


@query("op4_quality_rules", SQL)
def op4_quality_rules(spark, sf_dir):
    """The ledger of all documents under the production policy."""
    return apply_policy(ledger(load(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_upper", "fail_bits", "policy")
