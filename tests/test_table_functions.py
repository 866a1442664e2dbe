"""Table functions give the rows of the operators behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockloom.operators import lookups
from stockloom.plans.catalogue import QUERIES
from stockloom.plans.table_functions import register_table_functions
from stockloom.sources.star_schema import DEMAND_DATE
from conftest import DATA


def rows(df):
    return sorted(map(str, df.collect()))


def test_table_functions(spark, business):
    register_table_functions(spark, business.tables(), DEMAND_DATE)
    closure = lookups.location_closure(business["stock_location"])
    for place in (1, 10, 1001, 77):
        own = closure.filter(F.col("ancestor_id") == place).select(F.col("descendant_id").alias("location_id"), "name", "complete_name")
        assert rows(spark.sql(f"select * from child_locations({place})")) == rows(own)
    many = spark.sql("select w.id, c.location_id from __warehouses w join __location_closure s on s.ancestor_id = 1000 + w.id, lateral child_locations(1000 + w.id) c where s.descendant_id = s.ancestor_id")
    assert many.count() == closure.filter("ancestor_id >= 1000 and ancestor_id < 5000000000").count()

    flow = QUERIES["d2_stock_flow_report"](spark, DATA)
    place = flow.groupBy("location_id").count().orderBy(F.desc("count"), "location_id").first().location_id
    names = ["product_id", "default_code", "name", "qoh", "qty_in", "qty_out"]
    found = spark.sql(f"select * from stock_flow({place})")
    assert found.columns == names and rows(found) == rows(flow.filter(F.col("location_id") == place).select(*names)) != []

    stock = QUERIES["d6_available_for_product"](spark, DATA).filter("product_id = 7").select("warehouse_id", "warehouse_name", "available_qoh")
    assert rows(spark.sql("select * from available_stock(7)")) == rows(stock) != []
