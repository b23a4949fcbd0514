"""Types of texts, folded through a lattice.

``null < int < bigint < decimal < double < string``: each text has a level,
its whole digits and its scale, and a column's type follows from the maximum
of each, so the order of rows and the way they are split over tasks do not
matter. A type is only chosen if it holds every digit: numbers with leading
zeros, a plus sign or more than 38 digits stay text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("null", "int", "bigint", "decimal", "double", "string")
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_SPELLED = r"^[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]{1,4})?$"
_EXPONENT = r"^[+-]?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]{1,4}$"
#: Most numbers: canonical in either mode, and short enough to be sized by their length.
_SHORT = r"^-?(0|[1-9][0-9]{0,17})(\.[0-9]{1,18})?$"
MAX_DIGITS = 38


def learnt(texts: DataFrame, exact: bool = False) -> dict[int, str]:
    """DDL type of each ``pos`` in rows (pos, text), folded over all its texts.

    NULL and '' are null. One aggregate in fixed-width buffers, combined in
    every task; a row per ``pos`` comes back. ``exact`` takes a number with an
    exponent as the decimal it stands for, and every spelling of a number as
    that number (for sources that write numbers in one canonical form)."""
    text = F.col("text")
    mantissa = F.substring_index(F.translate(text, "e+-", "E"), "E", 1)
    fraction = F.when(F.contains(mantissa, F.lit(".")), F.length(F.substring_index(mantissa, ".", -1))).otherwise(0)
    # a leading zero is no digit of a decimal's precision, but one digit stays
    digits = F.greatest(F.length(F.ltrim(F.substring_index(mantissa, ".", 1), F.lit("0"))), F.lit(1))
    power = F.lit(0)
    if exact:
        power = F.when(text.rlike("[eE]"), F.substring_index(F.translate(text, "e", "E"), "E", -1).try_cast("int")).otherwise(0)
    number = text.rlike(_SPELLED if exact else _NUMBER)
    whole, scale = F.greatest(digits + power, F.lit(1)), F.greatest(fraction - power, F.lit(0))
    bare = (scale == 0) & ~text.rlike("[.eE]")
    level = (F.when(text.isNull() | (text == ""), 0)
             .when(number, F.when(bare & text.try_cast("int").isNotNull(), 1)
                   .when(bare & text.try_cast("bigint").isNotNull(), 2)
                   .when(whole + scale <= MAX_DIGITS, 3).otherwise(5))
             .when(F.lit(not exact) & text.rlike(_EXPONENT), 4).otherwise(5))
    dot, sign, length = F.instr(text, "."), F.startswith(text, F.lit("-")).cast("int"), F.length(text)
    short = F.struct(F.when(dot > 0, 3).when((length <= 9) | text.try_cast("int").isNotNull(), 1).otherwise(2).alias("level"),
                     (F.when(dot > 0, dot - 1).otherwise(length) - sign).alias("whole"),
                     F.when(dot > 0, length - dot).otherwise(0).alias("scale"))
    sized = texts.select("pos", F.when(text.rlike(_SHORT), short).otherwise(
        F.struct(level.alias("level"), whole.alias("whole"), scale.alias("scale"))).alias("of"))
    counted = F.col("of.level").between(1, 3)
    top = sized.groupBy("pos").agg(
        F.max("of.level").alias("level"), F.max(F.when(counted, F.col("of.whole"))).alias("whole"),
        F.max(F.when(counted, F.col("of.scale"))).alias("scale"))
    return {r.pos: ddl(r.level, r.whole, r.scale) for r in top.collect()}


def ddl(level: int | None, whole: int | None, scale: int | None) -> str:
    """Type of folded facts; without any value, text."""
    kind = LEVELS[level or 0]
    if kind == "decimal":
        return f"DECIMAL({whole + scale},{scale})" if whole + scale <= MAX_DIGITS else "STRING"
    return "STRING" if kind == "null" else kind.upper()


def csv_ddl(df: DataFrame, col: str, sep: str = ",") -> str:
    """Schema of a column of CSV lines, from all its values, as DDL with
    fields ``_c0``, ``_c1``, … Two aggregates: the largest number of fields
    (outside quotes), then the type of each field, a row a field."""
    line = F.col(f"`{col}`")
    # no repeated group: a doubled quote is two quoted runs side by side
    outside = F.regexp_replace(F.regexp_replace(line, r"\\.", ""), '"[^"]*"', "")
    count = F.size(F.split(outside, r"\Q" + sep + r"\E"))
    n = df.agg(F.max(F.when(line.isNotNull(), count)).alias("n")).first().n
    if n is None:
        raise ValueError(f"column {col} holds no CSV lines")
    texts = ", ".join(f"_c{i} STRING" for i in range(n))
    fields = df.select(F.from_csv(line, texts, {"sep": sep, "mode": "PERMISSIVE"}).alias("r"))
    types = learnt(fields.select(F.posexplode(F.array([f"r._c{i}" for i in range(n)])).alias("pos", "text")))
    return ", ".join(f"_c{i} {types.get(i, 'STRING')}" for i in range(n))
