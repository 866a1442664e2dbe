"""The lookups that return rows, as table functions of a session's SQL.

Each function selects from a temporary view over an operator that answers all keys at once. The argument becomes a filter of
that view, which Catalyst pushes down; called for many rows (``LATERAL``), it becomes a join. So ``spark.sql`` gets the same plans as
the DataFrame operators, and nothing runs until a query does.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stockloom.operators import balances, lookups
from stockloom.plans.confirmation_run import stock_closure

_DEFINITIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION child_locations(place BIGINT)
    RETURNS TABLE(location_id BIGINT, name STRING, complete_name STRING)
    RETURN SELECT descendant_id, name, complete_name FROM __location_closure WHERE ancestor_id = place""",
    """CREATE OR REPLACE TEMPORARY FUNCTION stock_flow(place BIGINT)
    RETURNS TABLE(product_id BIGINT, default_code STRING, name STRING, qoh DECIMAL(18,2), qty_in DECIMAL(18,2), qty_out DECIMAL(18,2))
    RETURN SELECT product_id, default_code, name, qoh, qty_in, qty_out FROM __stock_flow WHERE location_id = place""",
    """CREATE OR REPLACE TEMPORARY FUNCTION available_stock(product BIGINT)
    RETURNS TABLE(warehouse_id BIGINT, warehouse_name STRING, available_qoh DECIMAL(12,2))
    RETURN SELECT w.id, w.name, CAST(coalesce(a.available_qoh, 0) AS DECIMAL(12,2))
    FROM __warehouses w LEFT JOIN (SELECT * FROM __available WHERE product_id = product) a ON a.warehouse_id = w.id""",
)


def register_table_functions(spark: SparkSession, tables: Mapping[str, DataFrame], as_of: date) -> None:
    """Make ``child_locations(place)``, ``stock_flow(place)`` and ``available_stock(product)`` callable from ``spark.sql``.

    ``as_of`` is the day up to which open orders count as demand. Warehouses without stock of a product show 0.
    """
    moves, uoms, locations, warehouses = (tables[n] for n in ("stock_move", "product_uom", "stock_location", "stock_warehouse"))
    closure = lookups.location_closure(locations)
    on_hand = balances.qty_on_hand(moves, uoms, stock_closure(tables))
    demand = balances.pending_out(tables["sale_order"], tables["sale_order_line"], tables["res_partner"], as_of)
    views = {
        "__location_closure": closure,
        "__stock_flow": balances.stock_flow_report(moves, uoms, closure, tables["product_product"]),
        "__available": balances.available_qoh(on_hand, demand, warehouses, locations),
        "__warehouses": warehouses.select("id", "name"),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    for statement in _DEFINITIONS:
        spark.sql(statement)
