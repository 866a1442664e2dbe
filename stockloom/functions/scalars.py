"""Scalar rules: every function maps columns to a column and stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit names of the date difference.
YEAR_UNITS = ("yy", "yyyy", "year")
MONTH_UNITS = ("mm", "m", "month")
WEEK_UNITS = ("wk", "ww", "week")
DAY_UNITS = ("dd", "d", "day")
HOUR_UNITS = ("hh", "hour")
MINUTE_UNITS = ("mi", "n", "minute")

#: Time zone of the business calendar.
BUSINESS_ZONE = "Africa/Nairobi"

SUNDAY, MONDAY = 1, 2


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- fixed-scale assignment -------------------------------------------------------------------------------------------


def as_numeric(col: Column | str, precision: int, scale: int) -> Column:
    """Assignment to ``numeric(p, s)``: rounds half away from zero, overflow raises under ANSI."""
    return _col(col).cast(f"decimal({precision},{scale})")


def as_int(col: Column | str) -> Column:
    """Assignment of an exact number to an integer: rounds half away from zero (a bare cast would truncate)."""
    return F.round(_col(col), 0).cast("int")


def as_money(col: Column | str) -> Column:
    return as_numeric(col, 14, 2)


def half_money(col: Column | str) -> Column:
    """Half of a non-negative amount, cut to cents."""
    return (F.floor(_col(col) * 50) / F.lit(100).cast("decimal(3,0)")).cast("decimal(14,2)")


def round2(col: Column | str) -> Column:
    """Two decimals at most."""
    return _col(col).cast("decimal(38,2)")


# -- dates ------------------------------------------------------------------------------------------------------------


def datediff_units(unit: Column | str, start: Column | str, end: Column | str) -> Column:
    """Whole units between two timestamps, toward zero; unknown units count rounded seconds.

    ``unit`` is a literal name when given as ``str``. Years and months compare calendar parts only.
    """
    unit = F.lit(unit) if isinstance(unit, str) else unit
    start, end = _col(start).cast("timestamp_ntz"), _col(end).cast("timestamp_ntz")
    span = end - start
    years = F.year(end) - F.year(start)
    days = F.extract(F.lit("DAY"), span)
    hours = days * 24 + F.extract(F.lit("HOUR"), span)
    minutes = hours * 60 + F.extract(F.lit("MINUTE"), span)
    seconds = minutes * 60 + F.bround(F.extract(F.lit("SECOND"), span), 0).cast("int")
    return (
        F.when(unit.isin(*YEAR_UNITS), years)
        .when(unit.isin(*MONTH_UNITS), years * 12 + F.month(end) - F.month(start))
        .when(unit.isin(*WEEK_UNITS), (days / 7).cast("int"))
        .when(unit.isin(*DAY_UNITS), days)
        .when(unit.isin(*HOUR_UNITS), hours)
        .when(unit.isin(*MINUTE_UNITS), minutes)
        .otherwise(seconds)
        .cast("int")
    )


def skip_sunday(day: Column | str) -> Column:
    day = _col(day)
    return F.when(F.dayofweek(day) == SUNDAY, F.date_add(day, 1)).otherwise(day)


def new_delivery_date(date_order: Column | str, date_delivery: Column | str, from_date: Column | str) -> Column:
    """Promise the same lead time again, counted from ``from_date``; only lead times of 1 to 7 days are kept."""
    lead = F.datediff(_col(date_delivery), _col(date_order))
    shift = F.when(lead.between(1, 7), lead - 1).otherwise(0)
    return skip_sunday(F.date_add(_col(from_date), shift))


def business_day(ts: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """Local calendar day of a UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz")).cast("date")


def is_business_day(day: Column | str) -> Column:
    return F.dayofweek(_col(day)) != SUNDAY


def unpaid_cutoff(day: Column | str) -> Column:
    """Orders placed before this day without a down payment are cancelled; Monday looks past the weekend."""
    day = _col(day)
    return F.date_sub(day, F.when(F.dayofweek(day) == MONDAY, 3).otherwise(2))


# -- tax --------------------------------------------------------------------------------------------------------------


def tax_amount(
    price: Column | str, qty: Column | str, rate: Column | str, total_rate: Column | str, kind: Column | str
) -> Column:
    """Tax contained in a price that already includes all taxes; kinds other than percent and fixed give NULL."""
    qty, rate, kind = _col(qty), _col(rate), _col(kind)
    gross = (_col(price) * qty).cast("decimal(12,2)")
    return (
        F.when(kind == "percent", gross / (F.lit(1) + _col(total_rate)) * rate)
        .when(kind == "fixed", rate * qty)
        .cast("decimal(12,2)")
    )


# -- text -------------------------------------------------------------------------------------------------------------


def property_key(model: str, record_id: Column | str) -> Column:
    """Key of a record in the property store: ``model,id`` without spaces."""
    return F.regexp_replace(F.concat(F.lit(f"{model},"), _col(record_id).cast("string")), " ", "")


def reference_text(reference: Column | str, target: str) -> Column:
    return F.replace(_col(reference), F.lit(f"{target},"), F.lit(""))


def reference_id(reference: Column | str, target: str) -> Column:
    """Id inside a ``model,id`` reference; NULL when nothing numeric is left."""
    return reference_text(reference, target).try_cast("int")


def expand_prefix(prefix: Column | str, day: Column | str) -> Column:
    """Fill ``%(day)s``, ``%(month)s`` and ``%(year)s``; numbers are not padded."""
    text, day = _col(prefix), _col(day)
    for tag, part in (("%(day)s", F.dayofmonth(day)), ("%(month)s", F.month(day)), ("%(year)s", F.year(day))):
        text = F.replace(text, F.lit(tag), part.cast("string"))
    return text


def dash_label(code: Column | str, name: Column | str) -> Column:
    """``code - name``, NULL if either part is."""
    return F.concat(_col(code), F.lit(" - "), _col(name))


def bracket_label(code: Column | str, name: Column | str) -> Column:
    """``[code] name``, missing parts left empty."""
    return F.concat(
        F.lit("["), F.coalesce(_col(code), F.lit("")), F.lit("] "), F.coalesce(_col(name), F.lit(""))
    )


def posting_name(name: Column | str) -> Column:
    return F.substring(_col(name), 1, 64)


def posting_reference(number: Column | str) -> Column:
    return F.replace(_col(number), F.lit("/"), F.lit(""))
