"""Scalar column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
the expressions stay inside whole-stage codegen; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schema as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Remove leading and trailing white space the way Python's ``str.strip``
    does (all Unicode white space, not only blanks as ``trim`` does)."""
    return F.btrim(_col(c), F.lit(S.PY_WHITESPACE))


def norm_code(c) -> Column:
    """Upper-cased, stripped text; null stays null."""
    return F.upper(py_strip(c))


#: Digits of a unit price held exactly.
PRICE_DIGITS = 28


def money(c, scale: int = S.MONEY_SCALE) -> Column:
    """Exact decimal money value of a double price.  A positive price below
    the smallest unit counts as one unit, never as nothing; one of too many
    digits (or an infinite one) stops the job, naming it."""
    price = _col(c)
    kind = f"decimal({PRICE_DIGITS},{scale})"
    told = F.raise_error(F.concat(F.lit("price has too many digits: "), price.cast("string"))).cast(kind)
    exact = F.when(F.abs(price) >= F.lit(float(10 ** (PRICE_DIGITS - scale))), told).otherwise(price.cast(kind))
    unit = (F.lit(1) / F.lit(10**scale)).cast(kind)
    return F.when((price > 0) & (exact == 0), unit).otherwise(exact)


def line_money(price, quantity, scale: int = S.MONEY_SCALE, held: Column | None = None) -> Column:
    """Exact price * quantity.  The product of a price of more than 18 digits
    goes by its whole and its fractional part, which keeps all decimals.
    ``held`` may be a column that holds ``money(price, scale)``."""
    kind = f"decimal(38,{scale})"
    held, count = money(price, scale) if held is None else held, _col(quantity).cast("decimal(19,0)")
    plain = (held.cast(f"decimal(18,{scale})") * count).cast(kind)
    part = held % F.lit(1).cast("decimal(1,0)")
    whole = ((held - part).cast("decimal(20,0)") * count).cast(f"decimal({36 - scale},0)")
    wide = (whole + (part.cast(f"decimal({scale},{scale})") * count)).cast(kind)
    return F.when(F.abs(_col(price)) < F.lit(float(10 ** (18 - scale))) * 0.999, plain).otherwise(wide)


def money_scale(df, col: str = "net_gmv") -> int:
    """Decimals of the money columns of fact lines."""
    return df.schema[col].dataType.scale


def as_bool(c) -> Column:
    """Boolean from a boolean or text column: true iff its text is 'true' in
    any letter case (``True`` as pandas writes it, ``true`` as Spark does)."""
    return F.coalesce(F.lower(_col(c).cast("string")) == "true", F.lit(False))


def as_double(c) -> Column:
    return _col(c).cast("double")


def safe_ratio(num, den) -> Column:
    """``num / den`` where ``den > 0``, else 0.0 (never raises under ANSI)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def pct_change(cur, prev) -> Column:
    """``cur / prev - 1`` with the float semantics of an unguarded division:
    null when there is no previous value, +/-inf on a zero base, NaN for 0/0."""
    cur, prev = _col(cur).cast("double"), _col(prev).cast("double")
    return (
        F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
        .when(prev != 0, cur / prev - 1)
        .when(cur > 0, F.lit(float("inf")))
        .when(cur < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def change_or_null(cur, prev) -> Column:
    """``(cur - prev) / prev`` with NULL on a missing or zero base."""
    cur, prev = _col(cur).cast("double"), _col(prev).cast("double")
    return F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double")).otherwise((cur - prev) / prev)


# Period handling -------------------------------------------------------------

FREQS = ("M", "Q", "Y")


def check_freq(freq: str) -> str:
    if freq not in FREQS:
        raise ValueError(f"unknown period {freq!r}: use M (month), Q (quarter) or Y (year)")
    return freq


def period_start(date_col, freq: str) -> Column:
    """First day of the month / quarter / year holding ``date_col``."""
    unit = {"M": "MM", "Q": "QUARTER", "Y": "YEAR"}[check_freq(freq)]
    return F.trunc(_col(date_col), unit)


def period_ordinal(date_col, freq: str) -> Column:
    """Consecutive integer for the period (year*12+month, year*4+quarter, year)."""
    d = _col(date_col)
    check_freq(freq)
    if freq == "M":
        return F.year(d) * 12 + F.month(d)
    if freq == "Q":
        return F.year(d) * 4 + F.quarter(d)
    return F.year(d)


def period_label(date_col, freq: str) -> Column:
    """Text label: ``2010-12`` (M), ``2010Q4`` (Q), ``2010`` (Y)."""
    d = _col(date_col)
    check_freq(freq)
    if freq == "M":
        return F.date_format(d, "yyyy-MM")
    if freq == "Q":
        return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
    return F.year(d).cast("string")


def days_in_month(month_col) -> Column:
    return F.dayofmonth(F.last_day(_col(month_col)))


# Report text formats ----------------------------------------------------------


def _special_float(x: Column) -> Column:
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
    )


def fmt_pct(c) -> Column:
    """``12.3%``: one decimal, no thousands separator; ``NA`` when missing."""
    x = _col(c).cast("double") * 100
    body = F.regexp_replace(F.format_number(x, 1), ",", "")
    return F.coalesce(F.concat(F.coalesce(_special_float(x), body), F.lit("%")), F.lit("NA"))


def fmt_money(c) -> Column:
    """``1,234,568``: thousands separator, no decimals; ``NA`` when missing."""
    x = _col(c).cast("double")
    return F.coalesce(_special_float(x), F.format_number(x, 0), F.lit("NA"))


def fmt_decimal(c, digits: int = 4) -> Column:
    """Fixed number of decimals, no separator; ``NA`` when missing."""
    x = _col(c).cast("double")
    body = F.regexp_replace(F.format_number(x, digits), ",", "")
    return F.coalesce(_special_float(x), body, F.lit("NA"))
