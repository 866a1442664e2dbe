from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockloom.functions import scalars as fn
from stockloom.functions.sql import register_sql_functions


def one(spark, col, **values):
    names = {k: F.lit(v) for k, v in values.items()}
    return spark.range(1).select(*[c.alias(n) for n, c in names.items()]).select(col.alias("x")).collect()[0].x


DIFFS = [
    ("year", datetime(2020, 12, 31), datetime(2021, 1, 1), 1),
    ("mm", datetime(2020, 1, 31), datetime(2020, 2, 1), 1),
    ("week", datetime(2020, 1, 20), datetime(2020, 1, 1), -2),
    ("d", datetime(2020, 1, 2, 12), datetime(2020, 1, 1), -1),
    ("hour", datetime(2020, 1, 1), datetime(2020, 1, 2, 3, 59), 27),
    ("n", datetime(2020, 1, 1, 0, 1, 30), datetime(2020, 1, 1), -1),
    ("second", datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 0, 1, 500000), 2),
    ("anything", datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 1, 0, 400000), 60),
]


@pytest.mark.parametrize("unit, start, end, expected", DIFFS)
def test_datediff(spark, unit, start, end, expected):
    assert one(spark, fn.datediff_units(unit, "s", "e"), s=start, e=end) == expected
    register_sql_functions(spark)
    assert spark.sql(f"select datediff_units('{unit}', timestamp_ntz'{start}', timestamp_ntz'{end}') as x").collect()[0].x == expected


@pytest.mark.parametrize(
    "lead, start, expected",
    [(0, 2, 2), (1, 2, 2), (7, 2, 8), (8, 2, 2), (2, 1, 2), (1, 5, 6), (6, 7, 13), (None, 5, 6)],
)
def test_new_delivery_date(spark, lead, start, expected):
    # 2020-01-05 and 2020-01-12 are Sundays
    delivery = None if lead is None else date(2020, 3, 1 + lead)
    col = fn.new_delivery_date("o", F.lit(delivery).cast("date"), "f")
    assert one(spark, col, o=date(2020, 3, 1), f=date(2020, 1, start)) == date(2020, 1, expected)
    register_sql_functions(spark)
    text = "cast(null as date)" if delivery is None else f"date'{delivery}'"
    got = spark.sql(f"select new_delivery_date(date'2020-03-01', {text}, date'2020-01-{start:02}') as x").collect()[0].x
    assert got == date(2020, 1, expected)


@pytest.mark.parametrize("kind, expected", [("percent", "16.00"), ("fixed", "0.32"), ("code", None)])
def test_tax_amount(spark, kind, expected):
    col = fn.tax_amount(
        F.col("p").cast("decimal(14,2)"), F.lit(2), F.col("r").cast("decimal(12,6)"), F.col("r").cast("decimal(12,6)"), F.lit(kind)
    )
    assert one(spark, col, p="58.00", r="0.16") == (expected and Decimal(expected))


def test_rounding(spark):
    assert one(spark, fn.as_int(F.lit("2.5").cast("decimal(4,1)"))) == 3
    assert one(spark, fn.as_int(F.lit("-2.5").cast("decimal(4,1)"))) == -3
    assert one(spark, fn.half_money(F.lit("100.01").cast("decimal(14,2)"))) == Decimal("50.00")
    assert one(spark, fn.round2(F.lit("1.005").cast("decimal(18,6)"))) == Decimal("1.01")


def test_calendar(spark):
    assert one(spark, fn.business_day("t"), t=datetime(2001, 7, 29, 21, 30)) == date(2001, 7, 30)
    assert one(spark, fn.unpaid_cutoff("d"), d=date(2001, 7, 30)) == date(2001, 7, 27)
    assert one(spark, fn.unpaid_cutoff("d"), d=date(2001, 7, 31)) == date(2001, 7, 29)
    assert one(spark, fn.is_business_day("d"), d=date(2001, 7, 29)) is False


def test_text(spark):
    assert one(spark, fn.property_key("res. partner", F.lit(5))) == "res.partner,5"
    assert one(spark, fn.reference_id(F.lit("account.account,7"), "account.account")) == 7
    assert one(spark, fn.reference_id(F.lit(""), "account.account")) is None
    assert one(spark, fn.expand_prefix(F.lit("%(day)s.%(month)s.%(year)s-"), F.lit(date(2001, 7, 3)))) == "3.7.2001-"
    assert one(spark, fn.dash_label(F.lit(None).cast("string"), F.lit("x"))) is None
    assert one(spark, fn.bracket_label(F.lit(None).cast("string"), F.lit("x"))) == "[] x"
    assert one(spark, fn.posting_reference(F.lit("INV/2001/7"))) == "INV20017"
