"""Choice columns (one column, several value types) and their resolution.

A choice column holds values that each keep their own type
(``schema_of_variant``). It comes in two forms: a ``VARIANT`` (JSON values,
whose source spelling is not kept), or, from text, a struct of the typed
``value`` (VARIANT) and its source ``text``, so that no resolution to text
alters what was read: ``007``, ``199.50`` or a 20-digit id come back as they
were. Resolution actions (``resolveChoice``):

* ``cast:T``      every value cast to T; values that do not cast → NULL. From
  text, ``string`` is the text itself, and numbers are cast from the text, so
  a BIGINT or DECIMAL is exact; only plain numerals (``NUMERAL``) are numbers
* ``project:T``   keep rows whose value is of type T (NULLs kept), others dropped
* ``make_struct`` struct with one field per observed type, e.g. {double, string}
* ``make_array``  array holding the value (as text); NULL → NULL

All of it is JVM-side expressions; the only driver-side step is learning the
set of observed types for ``make_struct`` (a distinct over type names, bounded
by the number of types, never by the data).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.casting import spark_type

# Variant type names and the mapping type they resolve to.
VARIANT_TYPE_NAMES = {
    "DOUBLE": "double", "FLOAT": "float", "BIGINT": "bigint", "INT": "int",
    "SMALLINT": "smallint", "TINYINT": "tinyint", "STRING": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
    "TIMESTAMP_NTZ": "timestamp_ntz", "BINARY": "binary",
}


class ChoiceType(frozenset):
    """Set of type names a column may hold; ``add``/``merge`` are set unions."""

    def add(self, type_name: str) -> "ChoiceType":
        return ChoiceType(self | {type_name.lower()})

    def merge(self, other: Iterable[str]) -> "ChoiceType":
        return ChoiceType(self | {t.lower() for t in other})

    def __repr__(self) -> str:
        return f"choice({','.join(sorted(self))})"


# Plain numerals: sign, digits with an optional fraction, exponent; blanks
# around. Type letters (12D), hexadecimal, NaN and Infinity are text.
NUMERAL = r"^ *[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)? *$"

_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def plain_numeral(text: Column, type_name: str = "double") -> Column:
    """Value of a text that is a plain numeral, else NULL; NULL also beyond
    the type's range. Integer types take the whole part of a fraction, like
    the cast of a number does."""
    if type_name in _NUMERIC - {"float", "double"}:
        # exact where the text is a whole number, else through DECIMAL
        n = F.coalesce(text.try_cast(type_name), text.try_cast("decimal(38,10)").try_cast(type_name))
    else:
        n = text.try_cast(type_name)
        if type_name in ("float", "double"):
            n = F.when(F.abs(n) != float("inf"), n)
    return F.when(text.rlike(NUMERAL), n)


def text_to_choice(col: Column | str) -> Column:
    """Text → choice: plain numerals become DOUBLE values, the rest stay
    STRING; the text is kept beside either. NULL → NULL."""
    c = F.col(col) if isinstance(col, str) else col
    value = F.coalesce(plain_numeral(c).cast("variant"), c.cast("variant"))
    return F.when(c.isNotNull(), F.struct(value.alias("value"), c.alias("text")))


def is_text_choice(dtype: T.DataType) -> bool:
    """Whether a type is that of ``text_to_choice``."""
    return (isinstance(dtype, T.StructType) and dtype.fieldNames() == ["value", "text"]
            and dtype["value"].dataType.typeName() == "variant")


def _value(df: DataFrame, col: str) -> Column:
    """The VARIANT of a choice column of either form."""
    c = F.col(f"`{col}`")
    return c["value"] if is_text_choice(df.schema[col].dataType) else c


def json_to_choice(col: Column | str) -> Column:
    """JSON text → choice (``parse_json``; invalid JSON → NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c)


def value_type(col: Column | str) -> Column:
    """Observed type of each VARIANT value: 'DOUBLE', 'STRING', … ; NULL for missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull() & ~F.is_variant_null(c), F.schema_of_variant(c))


def _base_type(t: Column) -> Column:
    # DECIMAL(4,2) → DECIMAL, keeps type names comparable
    return F.regexp_replace(t, r"\(.*\)$", "")


def choice_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value_type, n): which types each column carries, with counts.

    One pass; the ``stack`` turns columns into rows and the partial aggregate
    is combined map-side (output size = columns × types)."""
    names = [F.lit(c).alias(f"n{i}") for i, c in enumerate(cols)]
    types = [value_type(_value(df, c)).alias(f"t{i}") for i, c in enumerate(cols)]
    parts = ", ".join(f"n{i}, t{i}" for i in range(len(cols)))
    long = df.select(*names, *types).select(F.expr(f"stack({len(cols)}, {parts}) AS (column, value_type)"))
    return long.groupBy("column", "value_type").agg(F.count(F.lit(1)).alias("n"))


def observed_types(df: DataFrame, col: str) -> list[str]:
    """Distinct value types of a column (a small set; sorted)."""
    rows = (df.select(_base_type(value_type(_value(df, col))).alias("t")).where("t IS NOT NULL")
            .distinct().collect())  # bounded by the number of variant types
    return sorted(r.t for r in rows)


def _reader(df: DataFrame, col: str):
    """``type name → Column``: the column's values cast to a type."""
    value = _value(df, col)
    if not is_text_choice(df.schema[col].dataType):
        return lambda name: F.try_variant_get(value, "$", spark_type(name))
    text = F.col(f"`{col}`")["text"]

    def read(name: str) -> Column:
        kind = spark_type(name).lower()
        if kind == "string":
            return text
        if kind in _NUMERIC or kind.startswith(("decimal", "numeric")):
            return plain_numeral(text, kind)
        return F.try_variant_get(value, "$", kind)

    return read


def resolve_column(df: DataFrame, col: str, action: str,
                   types: Sequence[str] | None = None) -> DataFrame:
    kind, _, arg = action.partition(":")
    kind = kind.strip().lower()
    read, t = _reader(df, col), _base_type(value_type(_value(df, col)))
    if kind == "cast":
        return df.withColumn(col, read(arg))
    if kind == "project":
        want = arg.strip().upper()
        kept = df.filter(t.isNull() | (t == F.lit(_variant_name(want))))
        return kept.withColumn(col, read(arg))
    if kind == "make_struct":
        ts = list(types) if types is not None else observed_types(df, col)
        fields = [F.when(t == F.lit(vt), read(_mapping_name(vt))).alias(_mapping_name(vt))
                  for vt in ts]
        return df.withColumn(col, F.struct(*fields) if fields else F.lit(None))
    if kind == "make_array":
        return df.withColumn(col, F.when(t.isNotNull(), F.array(read("string"))))
    raise ValueError(f"unknown resolve action {action!r}")


def _variant_name(name: str) -> str:
    st = spark_type(name.lower()).upper()
    return st


def _mapping_name(vt: str) -> str:
    return VARIANT_TYPE_NAMES.get(vt.upper(), vt.lower())


def resolve_choice(df: DataFrame, specs: Sequence[tuple[str, str]] | None = None,
                   choice: str | None = None) -> DataFrame:
    """``specs`` = [(column, action)] per column; ``choice`` = the action for
    every other choice column. Exactly one of them may be omitted."""
    done = set()
    out = df
    for col, action in specs or []:
        out = resolve_column(out, col, action)
        done.add(col)
    if choice:
        for f in df.schema.fields:
            if f.name not in done and (f.dataType.typeName() == "variant" or is_text_choice(f.dataType)):
                out = resolve_column(out, f.name, choice)
    return out
