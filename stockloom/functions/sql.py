"""The date and tax rules as session SQL functions; Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

_DEFINITIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION datediff_units(unit STRING, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ) RETURNS INT
    RETURN CAST(CASE
      WHEN unit IN ('yy', 'yyyy', 'year') THEN year(e) - year(s)
      WHEN unit IN ('mm', 'm', 'month') THEN (year(e) - year(s)) * 12 + month(e) - month(s)
      WHEN unit IN ('wk', 'ww', 'week') THEN extract(DAY FROM e - s) DIV 7
      WHEN unit IN ('dd', 'd', 'day') THEN extract(DAY FROM e - s)
      WHEN unit IN ('hh', 'hour') THEN extract(DAY FROM e - s) * 24 + extract(HOUR FROM e - s)
      WHEN unit IN ('mi', 'n', 'minute') THEN
        (extract(DAY FROM e - s) * 24 + extract(HOUR FROM e - s)) * 60 + extract(MINUTE FROM e - s)
      ELSE ((extract(DAY FROM e - s) * 24 + extract(HOUR FROM e - s)) * 60 + extract(MINUTE FROM e - s)) * 60
        + CAST(bround(extract(SECOND FROM e - s), 0) AS INT) END AS INT)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION new_delivery_date(ordered DATE, delivery DATE, from_date DATE) RETURNS DATE
    RETURN CASE WHEN datediff(delivery, ordered) BETWEEN 1 AND 7
      THEN date_add(from_date, datediff(delivery, ordered) - 1
        + CASE dayofweek(date_add(from_date, datediff(delivery, ordered) - 1)) WHEN 1 THEN 1 ELSE 0 END)
      ELSE date_add(from_date, CASE dayofweek(from_date) WHEN 1 THEN 1 ELSE 0 END) END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION tax_amount(
      price DECIMAL(14,2), qty INT, rate DECIMAL(12,6), total_rate DECIMAL(12,6), kind STRING) RETURNS DECIMAL(12,2)
    RETURN CAST(CASE kind
      WHEN 'percent' THEN CAST(price * qty AS DECIMAL(12,2)) / (1 + total_rate) * rate
      WHEN 'fixed' THEN rate * qty END AS DECIMAL(12,2))""",
)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``datediff_units``, ``new_delivery_date`` and ``tax_amount`` callable from ``spark.sql``."""
    for statement in _DEFINITIONS:
        spark.sql(statement)
