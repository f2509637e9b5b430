"""Column helpers: lenient casts, safe arithmetic, calendar keys, texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmill.constants import TRUE_WORDS


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- casts -----------------------------------------------------------------

def lenient_date(value: Column | str) -> Column:
    """Date, or null where the text is no date."""
    return _col(value).try_cast("date")


def lenient_double(value: Column | str) -> Column:
    """Double, or null where the text is no number. The text 'NaN' is null
    too: a NaN would rank above every number and spoil averages."""
    number = _col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def yes_no_flag(value: Column | str, dtype: str) -> Column:
    """1 / 0 from a boolean, numeric or text column; null and unknown text
    give 0. ``dtype`` is the Spark type name of the column."""
    c = _col(value)
    if dtype == "string":
        hit = F.lower(F.trim(c)).isin(*TRUE_WORDS)
    elif dtype == "boolean":
        hit = c
    else:
        hit = c != 0
    return flag(hit)


def one_zero(value: Column | str) -> Column:
    """Boolean to 1 / 0 with null kept."""
    return _col(value).cast("int")


# --- arithmetic ------------------------------------------------------------

def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom as double; null where the divisor is zero or null."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def percent_change(now: Column, before: Column, digits: int = 1) -> Column:
    """Change in percent, null when either side is null or ``before`` is 0."""
    return F.round(F.try_divide((now - before).cast("double"), before.cast("double")) * 100, digits)


def within(value: Column | str, low: float, high: float) -> Column:
    """The value, or null outside the closed band."""
    c = _col(value)
    return F.when(c.between(low, high), c)


def exact_sum(value: Column | str, scale: int = 4) -> Column:
    """Sum through decimal, so the result does not depend on row order."""
    return F.sum(F.round(_col(value), scale).cast(f"decimal(28,{scale})")).cast("double")


# --- flags -----------------------------------------------------------------

def flag(condition: Column) -> Column:
    """0 / 1 with an unknown condition counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


# --- calendar --------------------------------------------------------------

def month_text(day: Column | str) -> Column:
    """'YYYY-MM'; a null day stays null."""
    return F.date_format(_col(day), "yyyy-MM")


def month_index(month: Column | str) -> Column:
    """Consecutive month number of a 'YYYY-MM' text, for calendar distance."""
    c = _col(month)
    return F.substring(c, 1, 4).cast("int") * 12 + F.substring(c, 6, 2).cast("int")


def month_start(month: Column | str) -> Column:
    return F.to_date(F.concat(_col(month), F.lit("-01")))


def is_month_text(value: Column | str) -> Column:
    """True for 'YYYY' and 'YYYY-MM' shaped text."""
    return _col(value).rlike(r"^\d{4}(-\d{2})?$")


def day_span(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; a negative span is null."""
    days = F.datediff(_col(end).cast("date"), _col(start).cast("date"))
    return F.when(days >= 0, days)


# --- text ------------------------------------------------------------------

def signed_percent(value: Column | str, missing: str = "n/a") -> Column:
    """'+1.4%', '-1.5%', '+0%'; ``missing`` for null."""
    c = _col(value)
    number = F.regexp_replace(c.cast("string"), r"\.0$", "")
    text = F.concat(F.when(c >= 0, F.lit("+")).otherwise(F.lit("")), number, F.lit("%"))
    return F.coalesce(text, F.lit(missing))
