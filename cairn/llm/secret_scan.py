"""Secret scans with multipart credential linking.

Strong patterns (assignments, access ids, long hex) are always reported. Weak
candidates, 40-character keys and endpoints, are common in harmless text;
they are reported only when a complementary part lies within a scope of
``SCOPE`` characters around them. DataFrame functions only: regular
expressions give matches and the gaps between them, running sums of their
lengths give positions, and the interval join is a range frame over the spans
of a document, so no pair of spans is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.registry import query
from cairn.session import load

#: Kinds in the order of reports, their pattern, least length.
#: No pattern repeats a group: the regular expressions of the JVM recurse once per
#: repeat of a group, and a long text would exhaust the stack.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KEY = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"(?:[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20\"'<>]+|(?<![A-Za-z0-9.-])[a-z0-9-][a-z0-9.-]*\.amazonaws\.com)"
KINDS = ("assign", "access", "hex", "key", "endpoint")
BASE_KINDS = 3
#: Characters on either side of a weak candidate in which its parts must lie.
SCOPE = 400


def _matches(text: Column, kind: int, pattern: str, hint: Column, fails: str | None = None) -> Column:
    """Array of (kind, i, gap, len, ok): the characters since the last match, and of this one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), between.alias("g"))
    ok = lambda z: F.lit(True) if fails is None else ~z["m"].rlike(fails)
    spans = F.transform(
        F.filter(both, lambda z: z["m"].isNotNull()),
        lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(z["g"]).cast("long").alias("gap"),
                              F.length(z["m"]).cast("long").alias("len"), ok(z).alias("ok")))
    return F.when(hint, spans).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:bigint,len:bigint,ok:boolean>>"))


def _candidates(text: Column) -> Column:
    """All matches of all kinds, in one array; a cheap test skips texts without a kind."""
    return F.concat(
        # group 2 has fewer than 8 characters
        _matches(text, 0, ASSIGN, text.rlike(r"(?i)(?:passw|secret|token|api_?key)"),
                 r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{1,7}$"""),
        _matches(text, 1, ACCESS, F.contains(text, F.lit("AKIA")), r"^.{1,15}$"),
        _matches(text, 2, HEX, text.rlike(r"[0-9a-f]{32}")),
        _matches(text, 3, KEY, text.rlike(r"[A-Za-z0-9+/]{40}"), r"^(?:[^a-z]*|[^A-Z]*|[^0-9]*)$"),
        _matches(text, 4, ENDPOINT, F.contains(text, F.lit("://")) | F.contains(text, F.lit(".amazonaws.com"))))


def scan(docs: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per document: its key columns (doc_id) and ``spans``, an array of
    (start, kind, end) in code points, end exclusive, ordered by start and kind.

    Cases: a null or empty text has an empty array; a null doc_id and repeated
    rows keep one row each; texts are scanned whole; an empty table gives no
    rows; other columns are not read. Only spans are shuffled, not texts.
    """
    key = key or ["doc_id"]
    rows = docs.select(*key, _candidates(F.coalesce("text", F.lit(""))).alias("c"), F.monotonically_increasing_id().alias("row"))
    each = rows.select("row", *key, F.explode_outer("c").alias("x")).select("row", *key, "x.*")
    by_kind = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(by_kind)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).where("ok IS NULL OR ok")
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-SCOPE, SCOPE)
    seen = lambda *kinds: F.max(F.col("kind").isin(*kinds)).over(near)
    linked = spans.withColumn("id_near", seen(1)).withColumn("endpoint_near", seen(4)).withColumn("secret_near", seen(0, 2, 3))
    weak = (F.when(F.col("kind") == 3, F.col("id_near") | F.col("endpoint_near"))
            .when(F.col("kind") == 4, F.col("id_near") & F.col("secret_near")).otherwise(True))
    span = F.struct("start", "kind", "end")
    return linked.groupBy("row", *key).agg(
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull() & weak, span))).alias("spans")).drop("row")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all columns and rows stay.

    Documents are matched to their spans by content, so texts are scanned once
    per distinct text and only documents with a hit are rewritten.
    """
    h = [F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2")]
    texts = docs.where(F.size(_candidates(F.col("text"))) > 0).select("text", *h)
    hits = scan(texts, ["_h1", "_h2"]).where(F.size("spans") > 0).groupBy("_h1", "_h2").agg(F.min("spans").alias("_spans"))
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), *h)
    joined = whole.join(hits, ["_h1", "_h2"], "left")
    # overlapping spans: a span's piece begins where all before it have ended
    s = F.col("_spans")
    text = F.col("_row.text")
    before = F.transform(s, lambda x, i: F.coalesce(F.array_max(F.transform(F.slice(s, 1, i), lambda y: y["end"])), F.lit(0)))
    pieces = F.transform(F.arrays_zip(s.alias("s"), before.alias("b")), lambda z: F.when(
        z["s"]["start"] >= z["b"], F.concat(F.substring(text, (z["b"] + 1).cast("int"), (z["s"]["start"] - z["b"]).cast("int")), F.lit(mark))).otherwise(""))
    rest = F.substring(text, (F.array_max(F.transform(s, lambda x: x["end"])) + 1).cast("int"), F.length(text))
    clean = F.when(s.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return joined.select(*[clean.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names])


@query("op5_secret_scan")
def op5_secret_scan(spark, sf_dir):
    """Spans of all documents, with counts and a digest of the base kinds."""
    spans = scan(load(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
                        count(3).alias("n_key"), count(4).alias("n_endpoint"))
