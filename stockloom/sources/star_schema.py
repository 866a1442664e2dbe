"""The star-schema test tables recast into business tables.

Only integer arithmetic, exact decimals and deterministic keys are used. Every table is derived lazily; column
pruning drops whatever a query does not need, the line numbering window included.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stockloom.session import materialize
from stockloom.sources.schemas import TABLES
from stockloom.sources.tables import conform

#: Dates the registered queries use: a Monday, and the confirmation date of orders of one year.
RUN_DATE = date(2001, 7, 30)
CONFIRMED_ON = date(1997, 12, 31)
DEMAND_DATE = date(2000, 6, 15)

# Columns of the star-schema tables.
STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Nested-set numbers: region, nation, supplier and place packed into bit fields.
_SUPPLIER_BITS, _NATION_BITS = 32, 6
_NATION_STEP = 1 << _SUPPLIER_BITS
_REGION_STEP = 1 << (_SUPPLIER_BITS + _NATION_BITS)
_OUTSIDE = 30


def _date(col: str) -> Column:
    return F.col(col).cast("date")


class Business:
    """Business tables over a folder of star-schema parquet files, one attribute per table."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._scans: dict[str, DataFrame] = {}
        self._stored = False

    def raw(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = self.spark.read.schema(STAR_SCHEMA[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._scans[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}

    # -- places ---------------------------------------------------------------------------------------------------

    @cached_property
    def stock_location(self) -> DataFrame:
        nations, suppliers = self.raw("nation"), self.raw("supplier")

        def node(df: DataFrame, id_: Column, name: Column, usage: Column, r, n, s, k, level: int | None) -> DataFrame:
            r, n, s, k = (x if isinstance(x, Column) else F.lit(x) for x in (r, n, s, k))
            r, n, s = (x.cast("bigint") for x in (r, n, s))
            left = (r + 1) * F.lit(_REGION_STEP) + (n + 1) * F.lit(_NATION_STEP) + (s + 1) * 2 + k
            right = {
                0: F.lit(_OUTSIDE * _REGION_STEP - 1),
                1: (r + 2) * F.lit(_REGION_STEP) - 1,
                2: (r + 1) * F.lit(_REGION_STEP) + (n + 2) * F.lit(_NATION_STEP) - 1,
                3: left,
                None: F.when(id_ == 1, F.lit(_OUTSIDE * _REGION_STEP - 1)).otherwise(left),
            }[level]
            full = F.concat_ws("/", r.cast("string"), n.cast("string"), name)
            return df.select(
                id_.cast("bigint").alias("id"),
                name.alias("name"),
                full.alias("complete_name"),
                usage.alias("usage"),
                left.alias("parent_left"),
                right.alias("parent_right"),
            )

        placed = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
            "*",
            F.inline(
                F.array(
                    F.struct(F.lit(1000).cast("bigint").alias("base"), F.lit("/Stock").alias("label"), F.lit(0).alias("k")),
                    F.struct(F.lit(5_000_000_000).alias("base"), F.lit("/Output").alias("label"), F.lit(1).alias("k")),
                )
            ),
        )
        # The root, and places outside the tree of regions.
        outside = (
            (1, "ALL", "view", -1, -1, -1),
            (2, "Customers", "customer", _OUTSIDE, 2, 0),
            (3, "Vendors", "supplier", _OUTSIDE, 3, 0),
            (4, "Inventory loss", "inventory", _OUTSIDE, 4, 0),
            (5, "Scrapped", "inventory", _OUTSIDE, 5, 0),
        )
        names = ("i", "t", "u", "r", "n", "s")
        virtual = self.spark.range(1).select(
            F.inline(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row)]) for row in outside]))
        )
        region, nation, supplier = F.col("r_regionkey"), (F.col("n_regionkey"), F.col("n_nationkey")), F.col("s_suppkey")
        parts = [
            node(virtual, F.col("i"), F.col("t"), F.col("u"), F.col("r"), F.col("n"), F.col("s"), 0, None),
            node(self.raw("region"), 10 + region, F.col("r_name"), F.lit("view"), region, -1, -1, 0, 1),
            node(nations, 100 + F.col("n_nationkey"), F.col("n_name"), F.lit("view"), *nation, -1, 0, 2),
            node(
                placed, F.col("base") + supplier, F.concat("s_name", "label"), F.lit("internal"), *nation, supplier, F.col("k"), 3
            ),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return conform(out, "stock_location")

    @cached_property
    def stock_warehouse(self) -> DataFrame:
        key = F.col("s_suppkey")
        return conform(
            self.raw("supplier").select(
                key.alias("id"),
                F.col("s_name").alias("name"),
                F.when(key % 4 != 0, key - key % 4).alias("parent_warehouse_id"),
                (1000 + key).alias("lot_stock_id"),
                (5_000_000_000 + key).alias("wh_output_stock_loc_id"),
                (1000 + key).alias("wh_input_stock_loc_id"),
            ),
            "stock_warehouse",
        )

    @cached_property
    def ofc_locations(self) -> DataFrame:
        key = F.col("s_suppkey")
        slot = self.raw("supplier").select(key, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
        return conform(
            slot.select(
                (key * 10 + F.col("k")).alias("id"), key.alias("warehouse_id"), ((F.col("k") == 0) & (key % 10 != 9)).alias("is_default")
            ),
            "ofc_locations",
        )

    @cached_property
    def location_product_rel(self) -> DataFrame:
        rows = self.raw("lineitem").filter(F.col("l_linenumber") <= 2)
        place = F.col("l_suppkey") * 10 + 1 + F.col("l_partkey") % 2
        return conform(rows.select(place.alias("location_id"), F.col("l_partkey").alias("product_id")).distinct(), "location_product_rel")

    @cached_property
    def warehouse_product_rel(self) -> DataFrame:
        rows = self.raw("lineitem").filter(F.col("l_linenumber") <= 2)
        return rows.select(F.col("l_suppkey").alias("warehouse_id"), F.col("l_partkey").alias("product_id")).distinct()

    @cached_property
    def stock_picking_type(self) -> DataFrame:
        key, k = F.col("s_suppkey"), F.col("k")
        slot = self.raw("supplier").select(key, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
        return conform(
            slot.select(
                (key * 10 + k).alias("id"),
                ((k != 0) | (key % 6 != 0)).alias("active"),
                key.alias("warehouse_id"),
                F.when(k == 2, "incoming").otherwise("outgoing").alias("code"),
                F.when(k == 1, 1000 + key).when(k == 2, 3).alias("default_location_src_id"),
                F.when(k == 1, 2).alias("default_location_dest_id"),
            ),
            "stock_picking_type",
        )

    # -- products -------------------------------------------------------------------------------------------------

    @cached_property
    def product_uom(self) -> DataFrame:
        # Units and factors.
        return conform(
            self.spark.range(1).select(
                F.inline(
                    F.array(*[F.struct(F.lit(i).alias("id"), F.lit(f).alias("factor")) for i, f in ((1, 1.0), (2, 0.5), (3, 0.25))])
                )
            ),
            "product_uom",
        )

    @cached_property
    def product_product(self) -> DataFrame:
        key = F.col("p_partkey")
        return conform(
            self.raw("part").select(
                key.alias("id"),
                (key + 7).alias("product_tmpl_id"),
                F.when(key % 50 != 0, F.concat(F.lit("P"), (key - key % 2).cast("string"))).alias("default_code"),
                F.col("p_name").alias("name"),
                (F.col("p_size").cast("decimal(12,4)") * F.lit(25) / F.lit(100)).alias("weight"),
                (key % 17 != 0).alias("active"),
                F.when(key % 3 != 0, "real_time").otherwise("manual").alias("valuation"),
            ),
            "product_product",
        )

    @cached_property
    def product_template(self) -> DataFrame:
        key = F.col("p_partkey")
        return conform(
            self.raw("part").select(
                (key + 7).alias("id"),
                F.col("p_name").alias("name"),
                F.when(key % 50 != 0, F.concat(F.lit("T"), key.cast("string"))).alias("default_code"),
                F.when(F.col("p_type") == "LARGE", "big").otherwise("std").alias("size"),
                F.substring("p_brand", 7, 9).cast("bigint").alias("categ_id"),
                (key % 3 + 1).alias("uom_po_id"),
                (key % 4).alias("commissiontier_id"),
                (key % 13 != 0).alias("sale_ok"),
            ),
            "product_template",
        )

    @cached_property
    def product_category(self) -> DataFrame:
        # Parents of the first four families.
        key = F.col("id")
        parent = F.when(key == 1, 354).when(key == 2, 352).when(key.isin(3, 4), 365).otherwise(100)
        brands = self.raw("part").select("p_brand").distinct()
        rows = brands.select(F.substring("p_brand", 7, 9).cast("bigint").alias("id"), F.col("p_brand").alias("name"))
        return conform(rows.withColumn("parent_id", parent), "product_category")

    @cached_property
    def stock_warehouse_orderpoint(self) -> DataFrame:
        key = F.col("p_partkey")
        slot = self.raw("part").filter(key % 3 == 0).select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("w"))
        return conform(
            slot.select(
                (key * 10 + F.col("w")).alias("id"),
                F.col("w").alias("warehouse_id"),
                (1000 + F.col("w")).alias("location_id"),
                (1 + key % 2).alias("company_id"),
                key.alias("product_id"),
                (key % 7 != 0).alias("active"),
                F.lit(5).alias("product_min_qty"),
                (20 + F.col("p_size")).alias("product_max_qty"),
                (1 + F.col("p_size") % 4).alias("qty_multiple"),
            ),
            "stock_warehouse_orderpoint",
        )

    # -- partners and accounts ------------------------------------------------------------------------------------

    @cached_property
    def res_partner(self) -> DataFrame:
        key = F.col("c_custkey")
        return conform(
            self.raw("customer").select(
                key.alias("id"),
                (key % 3).alias("agent_type_id"),
                (key % 17).alias("route_id"),
                F.when(key % 8 != 5, (key * 7) % 10).alias("warehouse_id"),
            ),
            "res_partner",
        )

    @cached_property
    def res_company(self) -> DataFrame:
        key = F.col("r_regionkey")
        return conform(self.raw("region").select((key + 1).alias("id"), (100 + key).alias("currency_id")), "res_company")

    @cached_property
    def account_account(self) -> DataFrame:
        key = F.col("n_nationkey")
        return conform(self.raw("nation").select((690 + key).alias("id"), (key % 4 + 1).alias("user_type_id")), "account_account")

    @cached_property
    def account_journal(self) -> DataFrame:
        key = F.col("r_regionkey")
        code = F.when(key == 0, "INV").when(key == 1, "LPJ").otherwise(F.concat(F.lit("J"), key.cast("string")))
        return conform(
            self.raw("region").select(key.alias("id"), code.alias("code"), (690 + key).alias("default_debit_account_id")), "account_journal"
        )

    @cached_property
    def account_tax(self) -> DataFrame:
        # The taxes.
        rows = ((1, "Std", "0.16", "percent", True), (2, "Low", "0.08", "percent", True), (3, "Levy", "5", "fixed", True), (4, "Old", "0.20", "percent", False))
        structs = [
            F.struct(
                F.lit(i).alias("id"),
                F.lit(n).alias("name"),
                F.lit(a).alias("amount"),
                F.lit(k).alias("amount_type"),
                F.lit(on).alias("active"),
                F.lit(700 + i).alias("account_id"),
                F.lit(True).alias("price_include"),
                F.lit(False).alias("include_base_amount"),
            )
            for i, n, a, k, on in rows
        ]
        return conform(self.spark.range(1).select(F.inline(F.array(*structs))), "account_tax")

    @cached_property
    def product_taxes_rel(self) -> DataFrame:
        key = F.col("p_partkey")
        first, second = F.when(key % 5 != 0, 1 + key % 4), F.when((key % 7 == 0) & (key % 4 != 1), F.lit(2))
        slot = self.raw("part").select(key, F.explode(F.array(first.cast("int"), second)).alias("tax_id"))
        return conform(slot.filter(F.col("tax_id").isNotNull()).select((key + 7).alias("prod_id"), "tax_id"), "product_taxes_rel")

    @cached_property
    def ir_property(self) -> DataFrame:
        key = F.col("c_custkey")
        third = self.raw("customer").filter(key % 3 == 0)
        res = F.concat(F.lit("res.partner,"), key.cast("string"))
        own = third.select(
            F.lit("property_account_receivable_id").alias("name"),
            res.alias("res_id"),
            F.when(key % 6 == 0, "").otherwise(F.concat(F.lit("account.account,"), (700 + key % 9).cast("string"))).alias("value_reference"),
        )
        typed = third.select(
            F.lit("property_limit").alias("name"),
            res.alias("res_id"),
            F.when(key % 6 != 0, F.concat(F.lit("text "), key.cast("string"))).otherwise("").alias("value_text"),
            F.when(key % 9 != 0, key % 100).cast("int").alias("value_integer"),
            F.when(key % 9 != 0, (key % 100) / F.lit(4.0)).alias("value_float"),
            F.when(key % 9 != 0, F.date_add(F.lit(date(2020, 1, 1)), (key % 300).cast("int")))
            .cast("timestamp_ntz")
            .alias("value_datetime"),
        )
        one = self.spark.range(1)
        defaults = [
            one.select(F.lit("property_account_receivable_id").alias("name"), F.lit("account.account,699").alias("value_reference")),
            one.select(F.lit("property_limit").alias("name"), F.lit("42").alias("value_text")),
        ]
        out = conform(own, "ir_property").unionByName(conform(typed, "ir_property"))
        for row in defaults:
            out = out.unionByName(conform(row, "ir_property"))
        return out

    # -- orders ---------------------------------------------------------------------------------------------------

    @cached_property
    def sale_order(self) -> DataFrame:
        key, day, status = F.col("o_orderkey"), _date("o_orderdate"), F.col("o_orderstatus")
        return conform(
            self.raw("orders").select(
                key.alias("id"),
                F.concat(F.lit("SO"), key.cast("string")).alias("name"),
                (F.col("o_custkey") % 40).alias("partner_id"),
                F.col("o_custkey").alias("customer_id"),
                (1 + key % 2).alias("company_id"),
                day.alias("date_order"),
                F.date_add(day, (key % 9).cast("int")).alias("date_delivery"),
                F.when(status == "P", "draft").when(status == "O", "progress").otherwise("done").alias("state"),
                F.when(key % 43 != 0, key % 41 == 0).alias("is_duplicate"),
                (key % 29 == 0).alias("islayaway"),
                (key % 5 == 0).alias("requisitioned"),
                F.when(status != "P", F.make_date(F.year(day), F.lit(12), F.lit(31))).alias("confirmation_date"),
                (key % 6).alias("user_id"),
                (key % 4).alias("team_id"),
            ),
            "sale_order",
        )

    def number_lines(self, lineitem: DataFrame) -> DataFrame:
        """Order lines with an id and the helper columns other tables derive from."""
        rows = lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("warehouse"),
            F.col("l_linenumber").alias("linenumber"),
            F.col("l_extendedprice").alias("extended"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
            _date("l_shipdate").alias("ship_date"),
            (1 + F.col("l_quantity").cast("int") % 3).cast("int").alias("qty"),
        )
        place = Window.partitionBy("order_id").orderBy("linenumber", "product_id", "warehouse", "extended")
        return rows.withColumn("id", F.col("order_id") * 1000 + F.row_number().over(place))

    @cached_property
    def _lines(self) -> DataFrame:
        return self.number_lines(self.raw("lineitem"))

    def store_lines(self) -> None:
        """Number the lines once and store them, for plans that read several tables made of them."""
        if not self._stored:
            self._lines, self._stored = materialize(self._lines.drop("extended")), True

    @cached_property
    def _priced(self) -> DataFrame:
        prices = self.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"))
        factor = 1 + F.col("warehouse") % 2 + F.when(F.col("linenumber") == 7, 6).otherwise(0)
        return self._lines.join(prices, "product_id").withColumn("price_unit", (F.col("list_price") * factor).cast("decimal(12,2)"))

    @cached_property
    def sale_order_line(self) -> DataFrame:
        order, product, home = F.col("order_id"), F.col("product_id"), F.col("warehouse")
        return conform(
            self._priced.select(
                "id",
                "order_id",
                "product_id",
                (1 + product % 3).alias("product_uom"),
                F.col("qty").alias("product_uom_qty"),
                "price_unit",
                F.when((F.col("flag") == "R") & (F.col("status") == "O"), "cancel").otherwise("confirmed").alias("state"),
                F.concat(F.lit("Line "), F.col("id").cast("string")).alias("name"),
                F.when(order % 101 != 0, 1 + order % 2).alias("company_id"),
                home.alias("ofc_id"),
                F.when(home % 4 != 0, home - home % 4).alias("default_ofc_id"),
                F.when(product % 4 != 0, home * 10).alias("ofc_location_id"),
                (F.col("qty") * F.lit(3) / F.lit(2)).alias("commission"),
                (order % 40).alias("order_partner_id"),
            ),
            "sale_order_line",
        )

    @cached_property
    def sale_order_tax(self) -> DataFrame:
        rows = self._lines.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("tax_id"))
        return conform(
            rows.filter(F.col("id") % (F.col("tax_id") * 3) == 0).select(F.col("id").alias("order_line_id"), "tax_id"), "sale_order_tax"
        )

    @cached_property
    def account_voucher(self) -> DataFrame:
        key = F.col("o_orderkey")
        rows = self.raw("orders").filter(key % 3 == 0)
        return conform(
            rows.select(
                key.alias("order_id"),
                (2000 + (key % 11) * 1500).alias("amount"),
                F.when(key % 4 == 0, "draft").otherwise("booked").alias("state"),
            ),
            "account_voucher",
        )

    @cached_property
    def account_invoice_line(self) -> DataFrame:
        rows = self._lines.filter(F.col("flag") != "A")
        missing = F.when(F.col("linenumber") == 4, 1).otherwise(0)
        return conform(
            rows.select((F.col("id") * 2).alias("id"), F.col("id").alias("order_line_id"), (F.col("qty") - missing).alias("quantity")),
            "account_invoice_line",
        )

    @cached_property
    def wkf_instance(self) -> DataFrame:
        key = F.col("o_orderkey")
        return conform(
            self.raw("orders").select(
                (key * 3).alias("id"),
                key.alias("res_id"),
                F.when(key % 10 == 0, "stock.picking").otherwise("sale.order").alias("res_type"),
                F.when(key % 7 == 0, "active").otherwise("complete").alias("state"),
            ),
            "wkf_instance",
        )

    # -- stock ----------------------------------------------------------------------------------------------------

    @cached_property
    def stock_picking(self) -> DataFrame:
        key = F.col("o_orderkey")
        return conform(self.raw("orders").select(key.alias("id"), F.when(key % 3 == 0, "out").otherwise("in").alias("type")), "stock_picking")

    @cached_property
    def stock_move(self) -> DataFrame:
        flag, status, number = F.col("flag"), F.col("status"), F.col("linenumber")
        order, home, qty = F.col("order_id"), F.col("warehouse"), F.col("qty")
        remaining = F.when(flag == "A", qty).when((flag == "N") & (number % 2 == 0), -qty).otherwise(0)
        return conform(
            self._priced.select(
                "id",
                "product_id",
                F.lit(1).alias("company_id"),
                qty.alias("product_qty"),
                (1 + F.col("product_id") % 3).alias("product_uom"),
                F.when(order % 97 == 0, None).when(flag == "A", 3).otherwise(1000 + home).alias("location_id"),
                F.when(flag == "A", 1000 + home).when(flag == "N", 2).otherwise(1000 + home - home % 4).alias("location_dest_id"),
                F.when(status == "F", "done")
                .when(number % 3 == 0, "assigned")
                .when(number % 3 == 1, "confirmed")
                .otherwise("cancel")
                .alias("state"),
                order.alias("picking_id"),
                F.col("ship_date").alias("date"),
                "price_unit",
                remaining.alias("remaining_qty"),
                (remaining * F.col("price_unit")).alias("remaining_value"),
                (flag == "A").alias("is_in"),
                (flag == "N").alias("is_out"),
            ),
            "stock_move",
        )

    @cached_property
    def stock_quant(self) -> DataFrame:
        flag, qty = F.col("flag"), F.col("qty")
        return conform(
            self._priced.select(
                "id",
                "product_id",
                (1000 + F.col("warehouse")).alias("location_id"),
                F.when(flag == "A", qty).when(flag == "N", -qty).otherwise(0).alias("quantity"),
                F.col("price_unit").alias("unit_cost"),
                F.col("ship_date").alias("in_date"),
            ),
            "stock_quant",
        )

    @cached_property
    def stock_exceptions(self) -> DataFrame:
        rows = self.raw("lineitem").filter((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1))
        keys = rows.select(F.col("l_suppkey").alias("warehouse_id"), F.col("l_partkey").alias("product_id")).distinct()
        product = F.col("product_id")
        return conform(
            keys.select(
                "warehouse_id",
                "product_id",
                F.when(product % 3 == 0, F.lit(date(2001, 7, 29))).otherwise(F.lit(RUN_DATE)).alias("sync_date"),
                F.when(product % 5 == 0, "done").otherwise("new").alias("state"),
                F.lit(10).alias("initial_qoh"),
                F.lit(5).alias("kitted_qty"),
                F.lit(1).alias("adjusted_qty"),
            ),
            "stock_exceptions",
        )

    # -- queues ---------------------------------------------------------------------------------------------------

    def deliveries_of(self, lines: DataFrame) -> DataFrame:
        """Deliveries of order lines (``id, order_id, product_id, warehouse, qty, flag, ship_date``)."""
        key = F.col("id")
        copies = F.when(F.col("product_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = lines.filter(F.col("flag") == "N").select("*", F.explode(copies).alias("copy"))
        return conform(
            rows.select(
                (key * 10 + F.col("copy")).alias("id"),
                F.col("warehouse").alias("warehouse_id"),
                F.col("order_id").alias("receipt_id"),
                F.when(key % 89 != 0, key).alias("line_id"),
                "qty",
                (key % 7 == 0).alias("processed"),
                "order_id",
                F.when(F.col("order_id") % 13 != 0, F.col("order_id") % 6).alias("user_id"),
                F.concat(F.lit("R"), F.col("order_id").cast("string")).alias("receipt_ref"),
                F.when(F.col("order_id") % 3 == 0, F.col("ship_date")).alias("date_delivery"),
                F.when(F.col("order_id") % 6 != 1, F.date_add("ship_date", 1)).alias("date"),
            ),
            "ofs_delivery",
        )

    @cached_property
    def ofs_delivery(self) -> DataFrame:
        return self.deliveries_of(self._lines)

    def cancel_requests_of(self, lines: DataFrame) -> DataFrame:
        """Cancellation requests of numbered order lines."""
        number, home = F.col("linenumber"), F.col("warehouse")
        rows = lines.filter((F.col("flag") == "A") & (F.col("product_id") % 4 == 0))
        return conform(
            rows.select(
                "id",
                "order_id",
                F.when(number == 5, home + 1).otherwise(home).alias("ofc_id"),
                (F.col("product_id") % 6).alias("user_id"),
                F.when(number != 6, F.col("id")).alias("line_id"),
                (1 + F.col("product_id") % 3).alias("cancelled_qty"),
                F.lit(False).alias("processed"),
            ),
            "ofs_cancel_order",
        )

    @cached_property
    def ofs_cancel_order(self) -> DataFrame:
        return self.cancel_requests_of(self._lines)

    @cached_property
    def receipt_document(self) -> DataFrame:
        """Pickings that exist already for some receipts."""
        return self._documents("receipt_document", 23, "done")

    @cached_property
    def receipt_invoice(self) -> DataFrame:
        """Invoices that exist already for some receipts."""
        return self._documents("receipt_invoice", 31, "open")

    def _documents(self, table: str, every: int, state: str) -> DataFrame:
        """Documents of every so-manieth order's receipts, every second of them cancelled."""
        order = F.col("l_orderkey")
        rows = self.raw("lineitem").filter((F.col("l_returnflag") == "N") & (order % every == 0))
        keys = rows.select(F.col("l_suppkey").alias("warehouse_id"), order.alias("receipt_id")).distinct()
        return conform(keys.withColumn("state", F.when(F.col("receipt_id") % (2 * every) == 0, "cancel").otherwise(state)), table)
