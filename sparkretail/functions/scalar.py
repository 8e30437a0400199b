"""Column helpers for the warehouse functions the models use.

All helpers return JVM-side ``Column`` expressions (no Python UDFs), so they
stay inside whole-stage codegen. Each one pins a semantic that differs
between engines (see SURVEY §2.14):

* ``week_sunday`` - Sunday-based week number 0..53, not ISO ``weekofyear``.
* ``round_half_away`` - rounding half away from zero on the double value.
* ``exact_sum`` / ``exact_avg`` - sums of cents done in decimal so the result
  does not depend on the order rows are added in.
* ``to_int_rounded`` - float -> integer cast that rounds instead of truncating.
* ``safe_div`` / ``safe_double`` / ``na_to_double`` - NULL instead of errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Precision used for exact money sums: decimal(18, 2) keeps every partial sum
# below 2**53 cents, so the final cast to double is exact and identical in
# every engine.
MONEY_PRECISION = 18
MONEY_SCALE = 2


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_sunday(d: str | Column) -> Column:
    """Week of year with weeks starting on Sunday; days before the first
    Sunday are week 0 (strftime ``%U``)."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")


def round_half_away(col: str | Column, digits: int = 2) -> Column:
    """Round half away from zero: ``sign(v) * floor(|v| * 10^d + 0.5) / 10^d``."""
    v = _c(col)
    scale = float(10 ** digits)
    return F.signum(v) * F.floor(F.abs(v) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def to_money(col: str | Column, scale: int = MONEY_SCALE) -> Column:
    return _c(col).cast(f"decimal({max(MONEY_PRECISION, scale + 18)},{scale})")


def exact_sum(col: str | Column, scale: int = MONEY_SCALE) -> Column:
    """``sum`` of a cents-valued double, computed in decimal, returned as double."""
    return F.sum(to_money(col, scale)).cast("double")


def exact_avg(col: str | Column, scale: int = MONEY_SCALE) -> Column:
    """``avg`` over non-NULL values: exact decimal sum / count (NULL when no
    value). Algebraic, so partial aggregation still applies."""
    return F.try_divide(exact_sum(col, scale), F.count(_c(col)).cast("double"))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """NULL when the divisor is 0 or NULL (``safe_divide``)."""
    return F.try_divide(_c(num), _c(den))


def safe_double(col: str | Column) -> Column:
    """Lenient cast to double: unparsable text becomes NULL (``safe_cast``)."""
    return _c(col).try_cast("double")


def na_to_double(col: str | Column, token: str = "NA") -> Column:
    """``safe_cast(nullif(x, 'NA') as double)``."""
    return F.nullif(_c(col).cast("string"), F.lit(token)).try_cast("double")


def to_int_rounded(col: str | Column) -> Column:
    """Float -> 64-bit integer, rounding half away from zero (a plain Spark
    cast would truncate)."""
    return F.round(_c(col)).cast("bigint")


def strict_cast(col: str | Column, to: str, what: str = "value") -> Column:
    """Cast that raises on unparsable input whatever the ANSI setting."""
    c = _c(col)
    parsed = c.try_cast(to)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"invalid {what} for {to}: "), c.cast("string")))
                  ).otherwise(parsed)


def strict_date(col: str | Column, fmt: str = "yyyy-MM-dd", what: str = "date") -> Column:
    """``parse_date`` that raises on bad text (NULL stays NULL)."""
    c = _c(col)
    parsed = F.try_to_date(c.cast("string"), fmt)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"invalid {what}: "), c.cast("string")))
                  ).otherwise(parsed)


def strict_timestamp(col: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss",
                     what: str = "timestamp") -> Column:
    """``parse_timestamp`` to a zone-less timestamp; raises on bad text."""
    c = _c(col)
    parsed = F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("timestamp_ntz")
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"invalid {what}: "), c.cast("string")))
                  ).otherwise(parsed)


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 integer, NULL counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def positive_flag(col: str | Column) -> Column:
    """1 when the value is present and > 0 (``has_markdownN``)."""
    c = _c(col)
    return flag(c.isNotNull() & (c > 0))


def holiday_season(d: str | Column) -> Column:
    """1 for November and December."""
    return flag(F.month(_c(d)).isin(11, 12))


def weeks_before(d: str | Column, weeks: int) -> Column:
    return F.date_sub(_c(d), 7 * weeks)


def holiday_weight(is_holiday: str | Column, weight: int = 5) -> Column:
    """WMAE weight: 5 on holiday weeks, else 1."""
    c = _c(is_holiday)
    return F.when(c.cast("boolean"), F.lit(weight)).otherwise(F.lit(1)).cast("double")


def clip_at_zero(col: str | Column) -> Column:
    """Negative predictions -> 0."""
    return F.greatest(_c(col), F.lit(0.0))


# Fixed values shared with the reference: risk tiers on the coefficient of
# variation (strictly greater than), drift tiers on PSI (strictly less than).
RISK_HIGH = 0.5
RISK_MEDIUM = 0.25
PSI_LOW = 0.1
PSI_HIGH = 0.2


def risk_tier(cv: str | Column) -> Column:
    """HIGH when cv > 0.5, MEDIUM when > 0.25, else (NULL included) LOW."""
    c = _c(cv)
    return (F.when(c > RISK_HIGH, F.lit("HIGH"))
            .when(c > RISK_MEDIUM, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def drift_tier(psi: str | Column) -> Column:
    """LOW below 0.1, MEDIUM below 0.2, else HIGH."""
    c = _c(psi)
    return (F.when(c < PSI_LOW, F.lit("LOW"))
            .when(c < PSI_HIGH, F.lit("MEDIUM"))
            .otherwise(F.lit("HIGH")))


# Store type codes of the boosted-tree feature encoding.
STORE_TYPE_CODES = {"A": 0, "B": 1, "C": 2}


def encode_store_type(col: str | Column) -> Column:
    """A/B/C -> 0/1/2, anything else (NULL included) -> -1."""
    c = _c(col)
    expr = F.lit(-1)
    for k, v in reversed(list(STORE_TYPE_CODES.items())):
        expr = F.when(c == k, F.lit(v)).otherwise(expr)
    return expr.cast("int")
