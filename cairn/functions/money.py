"""Exact money arithmetic.

Amounts are summed and averaged in exact integer/decimal arithmetic at a
declared scale and rounded once, after the sum, so that ``round(…, 2)``
depends neither on the order in which partial sums were combined across tasks
(a double sum does) nor on rounding of single rows. Results are returned as
DOUBLE, like the reference's ``round(sum(x), 2)``. Halves round away from
zero, in sums and averages of either sign.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents_bigint(col) -> Column:
    """Two-decimal amount → exact cents as BIGINT.

    For partial sums over many rows: a BIGINT sum buffer is fixed-width and
    stays in the fast hash-aggregate path (a DECIMAL(38) one is not). Summed
    with a plain ``F.sum`` only where |amount| × rows per group provably stays
    below 9.2e16 (e.g. line quantities of at most a few thousand, over any
    number of lines); otherwise sum it with ``exact_sum``, which has no such
    bound in practice.
    """
    return F.round(_c(col) * 100).cast("bigint")


def from_cents(col) -> Column:
    """Exact DECIMAL(38,2) from a cents count."""
    return _c(col).cast("decimal(38,0)") * F.lit(Decimal("0.01"))


# Exact integer sums in fixed-width buffers. A BIGINT value v is split into
# hi = v >> LIMB_BITS and lo = v & (2^LIMB_BITS - 1) (so v = hi·2^LIMB_BITS + lo,
# 0 <= lo < 2^LIMB_BITS); both are summed as BIGINT -- the fast hash-aggregate
# path, combined map-side -- and put back together once per group as
# DECIMAL(38,0). Neither sum overflows for up to 2^43 rows per group with
# |v| < 2^40 (e.g. amounts below ten billion in cents), where a plain BIGINT
# sum could, and a DECIMAL(38) buffer would leave the fast path.
LIMB_BITS = 20


def exact_sum(units) -> Column:
    """Exact DECIMAL(38,0) ``sum`` of a BIGINT column (see ``LIMB_BITS``)."""
    v = _c(units).cast("bigint")
    hi = F.sum(F.shiftright(v, LIMB_BITS))
    lo = F.sum(v.bitwiseAND(F.lit((1 << LIMB_BITS) - 1)))
    return hi.cast("decimal(38,0)") * F.lit(1 << LIMB_BITS) + lo


#: Decimals that amounts may have where no scale is declared.
DEFAULT_SCALE = 12
#: Largest scale: a fraction at it still fits a BIGINT.
MAX_SCALE = 18


def exact_total(col, scale: int = DEFAULT_SCALE) -> Column:
    """Exact sum of amounts with up to ``scale`` decimals, as DECIMAL.

    A value is split into its whole part and its fraction in units of
    ``10^-scale``, both BIGINT, and each is summed in fixed-width buffers
    (``exact_sum``): whole parts up to 2^40, 2^43 rows a group. Digits beyond
    ``scale`` are rounded away row by row, so declare as many as there are.
    ``scale=2`` is the fast path: one BIGINT of cents a row.
    """
    if not 0 <= scale <= MAX_SCALE:
        raise ValueError(f"scale must be between 0 and {MAX_SCALE}")
    if scale == 2:
        return exact_sum(cents_bigint(col)) * F.lit(Decimal("0.01"))
    v = _c(col).cast(f"decimal(38,{scale})")
    whole = F.floor(v)
    units = ((v - whole) * F.lit(10 ** scale).cast("decimal(19,0)")).cast("bigint")
    return exact_sum(whole.cast("bigint")) + exact_sum(units).cast(f"decimal({38 - scale},0)") * F.lit(Decimal(1).scaleb(-scale))


def sum_2dp(col, scale: int = DEFAULT_SCALE) -> Column:
    """``round(sum(col), 2)`` of amounts with up to ``scale`` decimals, as DOUBLE."""
    return F.round(exact_total(col, scale), 2).cast("double")


def avg_2dp(col, scale: int = DEFAULT_SCALE) -> Column:
    """``round(avg(col), 2)`` of amounts with up to ``scale`` decimals, as DOUBLE.

    With S the sum in units of ``10^-scale`` and n the non-null count, the
    cents of the average are (200 |S| + n 10^scale) div (2 n 10^scale), with
    the sign of S; integral division keeps it exact at any size.
    """
    units = (exact_total(col, scale) * F.lit(10 ** scale).cast("decimal(19,0)")).cast("decimal(38,0)")
    n = F.count(_c(col)).cast("decimal(38,0)")
    if scale == 2:
        cents = _idiv(F.abs(units) * 2 + n, n * 2)
    else:
        per = F.lit(10 ** scale).cast("decimal(19,0)")
        cents = _idiv((F.abs(units) * 200 + n * per).cast("decimal(38,0)"), (n * 2 * per).cast("decimal(38,0)"))
    return F.when(n > 0, F.signum(units.cast("double")) * cents.cast("double") / F.lit(100.0))


def pct_2dp(part: Column, whole: Column) -> Column:
    """``round(part / whole * 100, 2)`` exactly, half up, for counts."""
    p = part.cast("decimal(38,0)")
    w = whole.cast("decimal(38,0)")
    return F.when(w > 0, _idiv(p * 20000 + w, w * 2).cast("double") / F.lit(100.0))


def _idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative DECIMAL(38,0) values: the
    dividend is made a multiple of the divisor first, so the decimal
    quotient carries no rounding."""
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


# DuckDB spellings of the same arithmetic, used by the oracle SQL texts.
def sql_sum_2dp(expr: str) -> str:
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(38,4))), 2) AS DOUBLE)"


def sql_avg_2dp(expr: str) -> str:
    """For averages that are not negative, of amounts with two decimals."""
    s = f"SUM(CAST(ROUND(({expr}) * 100) AS HUGEINT))"
    n = f"CAST(COUNT({expr}) AS HUGEINT)"
    return f"CAST(({s} * 2 + {n}) // ({n} * 2) AS DOUBLE) / 100.0"


def sql_pct_2dp(part: str, whole: str) -> str:
    return (f"CAST((CAST({part} AS HUGEINT) * 20000 + CAST({whole} AS HUGEINT))"
            f" // (CAST({whole} AS HUGEINT) * 2) AS DOUBLE) / 100.0")


def avg_from_parts(sum_cents: Column, n: Column) -> Column:
    """Half-up two-decimal average from a pre-aggregated cents sum and count."""
    s = sum_cents.cast("decimal(38,0)")
    n = n.cast("decimal(38,0)")
    return F.when(n > 0, _idiv(s * 2 + n, n * 2).cast("double") / F.lit(100.0))
