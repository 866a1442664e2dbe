"""What is broadcast must be small in memory, not only in its file."""

from __future__ import annotations

import __spark_entry__ as entry
from stockloom.session import broadcast_what_is_measured, materialize

ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def with_limits(spark, estimated, measured, run):
    before = {name: spark.conf.get(name, None) for name in (ESTIMATED, MEASURED)}
    try:
        for name, value in ((ESTIMATED, estimated), (MEASURED, measured)):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        return run()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_limits_are_lowered_never_raised(spark):
    def lowered():
        broadcast_what_is_measured(spark)
        return spark.conf.get(ESTIMATED), spark.conf.get(MEASURED, None)

    assert with_limits(spark, "10MB", None, lowered) == ("262144", "2097152")
    assert with_limits(spark, "1m", None, lowered) == ("262144", "1048576")
    assert with_limits(spark, "10485760b", "5k", lowered) == ("262144", "5k")
    assert with_limits(spark, "64k", None, lowered) == ("64k", None)
    assert with_limits(spark, "-1", None, lowered) == ("-1", None)


def test_a_table_packed_well_is_not_broadcast_by_its_file_size(spark):
    """A few megabytes of file are 24 MB of rows here; a registered query sets the limits in whatever session it gets."""
    rows = materialize(spark.range(0, 1_000_000, 1, 2).selectExpr("id", "id div 1000 as place"))

    def plan():
        entry.queries()["b7_labels"](spark, "/root/testdata/sf0.001")
        joined = rows.join(rows.selectExpr("id", "place as there"), "id")
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" not in with_limits(spark, "10MB", None, plan)
