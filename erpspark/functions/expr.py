"""Column helpers: arithmetic that keeps decimals exact, date keys, NULL handling.

Sums stay in decimal, ratios are taken in double, and rounding always goes
through a decimal so that .5 is rounded away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(22,4)"
UNKNOWN_DATE_KEY = 19000101


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in double; NULL when the denominator is zero or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def rounded(c: Column | str, digits: int = 0) -> Column:
    """Half-away-from-zero rounding with a decimal result."""
    return F.round(col(c).cast("decimal(38,8)"), digits)


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return rounded(ratio(num, den) * 100, digits)


def exact_avg(c: Column | str, scale: int = 4) -> Column:
    """Average whose sum is exact, so the result does not depend on row order."""
    c = col(c)
    return ratio(F.sum(c.cast(f"decimal(28,{scale})")), F.count(c))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def date_key(c: Column | str, default: int | None = None) -> Column:
    """YYYYMMDD integer of a date or timestamp."""
    key = F.date_format(col(c).cast("date"), "yyyyMMdd").cast("int")
    return key if default is None else F.coalesce(key, F.lit(default))


def key_to_date(c: Column | str) -> Column:
    return F.try_to_date(col(c).cast("string"), "yyyyMMdd")


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c).cast("date"), "MM")


def trimmed_or(c: Column | str, fallback: str) -> Column:
    """Trimmed text, or the fallback when it is NULL or blank."""
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(fallback))


def first_match(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """Ordered rules; the first one that holds gives the value."""
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(otherwise)


def price_tier(price: Column | str, low: Column, high: Column) -> Column:
    """Low up to the first threshold, Mid up to the second, High above; NULL for no price."""
    p = col(price)
    return first_match(
        [
            (p.isNull() | (p == 0), F.lit(None).cast("string")),
            (p <= low, "Low"),
            (p <= high, "Mid"),
        ],
        "High",
    )


_PLAIN = {"l": "bigint", "d": "double", "s": "string", "t": "date", "b": "boolean"}


def shape(df: DataFrame, spec: str) -> DataFrame:
    """Select ``"name:type name:type"`` with plain types (l d s t b)."""
    cols = []
    for item in spec.split():
        name, kind = item.split(":")
        cols.append(F.col(name).cast(_PLAIN[kind]).alias(name))
    return df.select(*cols)
