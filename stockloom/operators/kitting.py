"""Kitting: turn delivered receipts into stock consumption and chained transfers, all receipts at once."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import as_int, as_numeric
from stockloom.operators.allocation import match_intervals
from stockloom.operators.intake import RECEIPT, unprocessed
from stockloom.operators.joins import attach
from stockloom.operators.lookups import locations_of_type, match_picking_type, only_known, usage_location
from stockloom.operators.maintenance import accumulate, number_documents
from stockloom.operators.ordered import id_block, in_pieces, running
from stockloom.session import materialize

INVALID_REMARK = "invalid order"
DONE_REMARK = "processed successfully"
#: Columns of kit lines that no step of a transfer computes with.
_DESCRIPTIVE = {"product_name", "product_uom", "ordered_qty", "company_id", "order_name", "weight", "date_expected"}
#: Lots without a date are used last.
UNDATED = date(9999, 12, 31)


def usable_deliveries(
    deliveries: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame, templates: DataFrame, today: date
) -> DataFrame:
    """Unprocessed deliveries with a live order line: quantity, weight, agent's centre and promised date.

    Lines that bring ``unit_weight`` were joined with their products already. ``ordered_qty`` needs lines with a quantity.
    """
    known = (
        products.select(F.col("id").alias("product_id"), "product_tmpl_id", F.col("weight").alias("unit_weight"))
        .join(templates.select(F.col("id").alias("product_tmpl_id")), "product_tmpl_id", "left_semi")
        .select("product_id", "unit_weight")
    )
    heads = orders.filter(~F.col("state").isin("draft", "cancel")).select(
        F.col("id").alias("order_id"),
        F.col("name").alias("order_name"),
        "partner_id",
        "company_id",
        F.coalesce("date_delivery", F.lit(today + timedelta(days=1))).alias("date_expected"),
    )
    ordered = lines.select(
        F.col("id").alias("order_line_id"),
        "order_id",
        "product_id",
        F.col("name").alias("product_name"),
        *([as_int("product_uom_qty").alias("ordered_qty")] if "product_uom_qty" in lines.columns else []),
        "product_uom",
        "default_ofc_id",
        *[c for c in lines.columns if c == "unit_weight"],
    )
    delivered = deliveries.filter(unprocessed()).select(
        F.col("id").alias("delivery_id"), *RECEIPT, F.col("line_id").alias("order_line_id"), "qty", "receipt_ref"
    )
    rows = delivered.join(ordered, "order_line_id").join(heads, "order_id")
    rows = rows if "unit_weight" in lines.columns else rows.join(known, "product_id")
    return rows.select(
        "delivery_id",
        *RECEIPT,
        "order_line_id",
        "order_id",
        "order_name",
        "partner_id",
        "company_id",
        "product_id",
        "product_name",
        "product_uom",
        *[c for c in rows.columns if c == "ordered_qty"],
        F.col("qty").alias("product_uom_qty"),
        as_numeric(F.col("qty") * F.coalesce("unit_weight", F.lit(0)), 12, 4).alias("weight"),
        F.coalesce("default_ofc_id", "warehouse_id").alias("default_ofc_id"),
        "receipt_ref",
        "date_expected",
    )


def kitting_lines(
    usable: DataFrame,
    flows: DataFrame,
    closure: DataFrame,
    uoms: DataFrame,
    partners: DataFrame,
    warehouses: DataFrame,
    locations: DataFrame,
    pieces: int | None = None,
) -> DataFrame:
    """Usable deliveries with ``product_qoh``, the stock of the centre when their receipt's turn comes.

    Receipts take their turns in the order of ``(warehouse_id, receipt_id)``. A turn sees the done moves before the run
    (``flows``, of :func:`~stockloom.operators.balances.subtree_flows` over at least the stock places of ``closure``) and
    the done legs of all earlier receipts of the run, in their units, wherever these cross the border of the stock place.
    As ever, stock is 0 as long as nothing has come in.
    """
    place = locations_of_type(warehouses, locations, "stock")
    rows = attach(usable, place, {"warehouse_id": "warehouse_id"})
    key = ["location_id", "product_id"]
    turns = rows.filter(F.col("location_id").isNotNull()).select(*key, *RECEIPT).distinct()
    earlier = _flows_of_earlier_receipts(turns, usable, closure, uoms, partners, warehouses, pieces)
    before = flows.groupBy(*key).agg(F.sum("qty_in").alias("__in"), F.sum("qty_out").alias("__out"), F.bool_or("has_in").alias("__has_in"))
    seen = attach(earlier, before, {c: c for c in key})
    net = F.coalesce("__in", F.lit(0)) + F.col("run_in") - F.coalesce("__out", F.lit(0)) - F.col("run_out")
    arrived = F.coalesce("__has_in", F.lit(False)) | (F.col("run_ins") > 0)
    stock = as_int(as_numeric(F.when(arrived, net).otherwise(0), 12, 2)).alias("product_qoh")
    rows = attach(rows, seen.select(*key, *RECEIPT, stock), {c: c for c in (*key, *RECEIPT)})
    return rows.withColumn("product_qoh", F.coalesce("product_qoh", F.lit(0))).drop("location_id")


def _flows_of_earlier_receipts(
    turns: DataFrame, usable: DataFrame, closure: DataFrame, uoms: DataFrame, partners: DataFrame, warehouses: DataFrame, pieces: int | None
) -> DataFrame:
    """``turns`` with ``run_in``, ``run_out`` and ``run_ins``: what earlier receipts bring into and take out of the place.

    Only stock to output and output to the agent's output are done within a run. Which stock places such a leg touches
    depends on centre and agent alone, so the tree is asked once for each pair of them, never per line.
    """
    key = ["location_id", "product_id"]
    agent = receipt_agents(usable)
    moved = attach(only_known(usable, partners, "partner_id"), agent, {c: c for c in RECEIPT})
    moved = (
        moved.groupBy(*RECEIPT, "agent_warehouse_id", "product_id", "product_uom")
        .agg(F.sum("product_uom_qty").alias("qty"), F.count(F.lit(1)).alias("moves"))
        .join(uoms.select(F.col("id").alias("product_uom"), "factor"), "product_uom")
        .withColumn("qty", (F.col("qty") / F.col("factor")).cast("decimal(28,10)"))
    )
    touched = _stock_borders(moved.select("warehouse_id", "agent_warehouse_id").distinct(), closure, warehouses)
    flows = attach(moved, touched, {"warehouse_id": "warehouse_id", "agent_warehouse_id": "agent_warehouse_id"})
    flows = flows.select(*RECEIPT, "product_id", "qty", "moves", F.explode("borders").alias("b")).select(
        F.col("b.location_id").alias("location_id"),
        "product_id",
        *RECEIPT,
        F.when(F.col("b.is_in"), F.col("qty")).alias("in"),
        F.when(~F.col("b.is_in"), F.col("qty")).alias("out"),
        F.when(F.col("b.is_in"), F.col("moves")).alias("ins"),
        F.lit(False).alias("turn"),
    )
    both = flows.unionByName(turns.withColumn("turn", F.lit(True)), allowMissingColumns=True)
    each = both.groupBy(*key, *RECEIPT).agg(*[F.sum(c).alias(c) for c in ("in", "out", "ins")], F.max("turn").alias("turn"))
    each = in_pieces(each, key, RECEIPT, pieces)
    sums = {f"run_{c}": F.coalesce(c, F.lit(0)) for c in ("in", "out", "ins")}
    return running(each, sums, "sum", key, ["piece"], RECEIPT).filter("turn").select(*key, *RECEIPT, *sums)


def _stock_borders(pairs: DataFrame, closure: DataFrame, warehouses: DataFrame) -> DataFrame:
    """``(warehouse_id, agent_warehouse_id, borders)``: the stock places whose border the done legs cross, and the way."""
    places = warehouses.select(
        F.col("id").alias("warehouse_id"), F.col("lot_stock_id").alias("stock"), F.col("wh_output_stock_loc_id").alias("output")
    )
    agents = places.select(F.col("warehouse_id").alias("agent_warehouse_id"), F.col("output").alias("agent_output"))
    routed = pairs.join(places, "warehouse_id").join(agents, "agent_warehouse_id", "left")
    leg = lambda source, dest: F.struct(F.col(source).alias("source"), F.col(dest).alias("dest"))
    transit = F.col("agent_warehouse_id") != F.col("warehouse_id")
    legs = F.when(transit, F.array(leg("stock", "output"), leg("output", "agent_output"))).otherwise(F.array(leg("stock", "output")))
    key = ["warehouse_id", "agent_warehouse_id"]
    routed = routed.select(*key, F.posexplode(legs).alias("leg", "l")).filter("l.source <> l.dest")
    sides = F.array(
        F.struct(F.lit(True).alias("is_in"), F.col("l.dest").alias("node"), F.col("l.source").alias("other")),
        F.struct(F.lit(False).alias("is_in"), F.col("l.source").alias("node"), F.col("l.dest").alias("other")),
    )
    ends = routed.select(*key, "leg", F.explode(sides).alias("s")).select(*key, "leg", "s.*")
    stock = closure.join(places.select(F.col("stock").alias("ancestor_id")).distinct(), "ancestor_id", "left_semi")
    inside = ends.join(stock.select(F.col("ancestor_id").alias("location_id"), F.col("descendant_id").alias("node")), "node")
    outside = stock.select(F.col("ancestor_id").alias("location_id"), F.col("descendant_id").alias("other"))
    crossing = inside.join(outside, ["location_id", "other"], "left_anti")
    return crossing.groupBy(*key).agg(F.collect_list(F.struct("location_id", "is_in", "leg")).alias("borders"))


def receipt_routes(kit_lines: DataFrame) -> DataFrame:
    """``(warehouse_id, receipt_id, partner_id, agent_warehouse_id)`` of :func:`receipt_totals` alone: all that tells which legs there are."""
    lead = F.max_by(F.struct("default_ofc_id", "partner_id"), "order_line_id").alias("l")
    return kit_lines.groupBy(*RECEIPT).agg(lead).select(*RECEIPT, "l.partner_id", F.col("l.default_ofc_id").alias("agent_warehouse_id"))


def receipt_totals(kit_lines: DataFrame) -> DataFrame:
    """Weight, line count and the leading order and agent centre (of the largest line id) per receipt."""
    lead = F.max_by(F.struct("order_id", "default_ofc_id", "order_name", "partner_id", "company_id", "receipt_ref"), "order_line_id")
    return (
        kit_lines.groupBy(*RECEIPT)
        .agg(as_numeric(F.sum("weight"), 18, 4).alias("weight"), F.count(F.lit(1)).alias("items"), lead.alias("l"))
        .select(
            *RECEIPT, "weight", "items", "l.order_id", "l.order_name", "l.partner_id", "l.company_id", "l.receipt_ref",
            F.col("l.default_ofc_id").alias("agent_warehouse_id"),
        )
    )


def receipt_agents(kit_lines: DataFrame) -> DataFrame:
    """``(warehouse_id, receipt_id, agent_warehouse_id)`` of :func:`receipt_totals` alone, without its wide leading row."""
    return kit_lines.groupBy(*RECEIPT).agg(F.max_by("default_ofc_id", "order_line_id").alias("agent_warehouse_id"))


def invalid_changes(deliveries: DataFrame, kit_lines: DataFrame) -> DataFrame:
    """Change set closing unprocessed deliveries of receipts without any usable line."""
    usable = kit_lines.select(*RECEIPT)
    return deliveries.filter(unprocessed()).join(usable, RECEIPT, "left_anti").select(
        "id", F.lit(True).alias("processed"), F.lit(INVALID_REMARK).alias("remarks")
    )


def upsert_stock_exceptions(exceptions: DataFrame, kit_lines: DataFrame, today: date) -> DataFrame:
    """The exception table after kitting, receipt by receipt in the order of their ids.

    Where a warehouse and product have an open row of today, every line adds its quantity and ``adjusted_qty`` becomes 0.
    Where they have none, the first receipt with a line that wants more than the stock of its turn inserts one; lines
    before it leave no trace, those of later receipts add up. Of the inserting receipt only the short lines count; several of
    them make one row.
    """
    keys = ["warehouse_id", "product_id"]
    wanted, stock = F.col("product_uom_qty"), F.col("product_qoh")
    receipts = kit_lines.groupBy(*keys, "receipt_id").agg(
        F.sum(wanted).alias("qty"), F.sum(F.when(wanted - stock > 0, wanted)).alias("short"), F.max(stock).alias("qoh")
    )
    current = (F.col("sync_date") == F.lit(today)) & (F.col("state") == "new")
    opened = F.coalesce(current, F.lit(False))
    kitted = receipts.groupBy(*keys).agg(F.sum("qty").alias("kitted_qty"))
    touched = accumulate(exceptions.filter(opened), kitted, keys, "kitted_qty", F.lit(False), reset=["adjusted_qty"])

    first = receipts.filter("short is not null").groupBy(*keys).agg(F.min("receipt_id").alias("first"))
    first = first.join(exceptions.filter(opened).select(*keys), keys, "left_anti")
    crossing = F.col("receipt_id") == F.col("first")
    counted = F.when(crossing, F.col("short")).when(F.col("receipt_id") > F.col("first"), F.col("qty"))
    inserted = receipts.join(first, keys).groupBy(*keys).agg(
        F.max(F.when(crossing, F.col("qoh"))).alias("initial_qoh"), F.sum(counted).alias("kitted_qty")
    )
    inserted = inserted.withColumns({"adjusted_qty": F.lit(0), "state": F.lit("new"), "sync_date": F.lit(today)})
    shaped = [
        (F.col(f.name) if f.name in inserted.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in exceptions.schema.fields
    ]
    return touched.unionByName(inserted.select(*shaped)).unionByName(exceptions.filter(~opened))


def consume_quants(
    demand: DataFrame, quants: DataFrame, stock_locations: DataFrame, pieces: int | None = None
) -> DataFrame:
    """Lots consumed first-in-first-out by ``demand`` (``id, order_line_id, warehouse_id, product_id, qty``).

    Lots at the warehouse's stock place are used by date and id, demand is served by id. What no lot covers comes out
    as one negative row without a lot. The positions of both sides are stored, as several steps read them. Returns ``demand_id, order_line_id, quant_id, quant_qty, quant_cost``.
    """
    keys = ["warehouse_id", "product_id"]
    wanted = demand.filter(F.col("qty") > 0).select(
        *keys, "id", "order_line_id", F.col("qty").cast("decimal(18,4)").alias("need")
    )
    wanted = in_pieces(wanted, keys, ["id"], pieces)
    wanted = materialize(running(wanted, {"lo": F.col("need")}, "sum", keys, ["piece"], ["id"]))
    held = (
        quants.filter(F.col("quantity") > 0)
        .withColumn("in_date", F.coalesce("in_date", F.lit(UNDATED)))
        .join(stock_locations, "location_id")
        .join(wanted.select(*keys), keys, "left_semi")
        .select(*keys, "id", "unit_cost", "in_date", F.col("quantity").cast("decimal(18,4)").alias("have"))
    )
    held = in_pieces(held, keys, ["in_date", "id"], pieces)
    held = materialize(running(held, {"lo": F.col("have")}, "sum", keys, ["piece"], ["in_date", "id"]))
    taken = match_intervals(
        wanted.select(
            *keys, F.struct("id", "order_line_id").alias("id"), F.col("piece").alias("chunk"), "lo", (F.col("lo") + F.col("need")).alias("hi")
        ),
        held.select(
            *keys, F.struct("id", "unit_cost").alias("id"), F.col("piece").alias("chunk"), "lo", (F.col("lo") + F.col("have")).alias("hi")
        ),
        keys,
    ).select(
        F.col("demand_id.id").alias("demand_id"),
        F.col("demand_id.order_line_id").alias("order_line_id"),
        F.col("supply_id.id").alias("quant_id"),
        as_numeric("qty", 18, 4).alias("quant_qty"),
        as_numeric("supply_id.unit_cost", 12, 4).alias("quant_cost"),
    )
    supply = held.groupBy(*keys).agg(F.sum("have").alias("__supply"))
    covered = F.greatest(F.col("lo"), F.coalesce("__supply", F.lit(0)))
    short = attach(wanted, supply, {c: c for c in keys}).withColumn("__short", F.col("lo") + F.col("need") - covered)
    missing = short.filter(F.col("__short") > 0).select(
        F.col("id").alias("demand_id"),
        "order_line_id",
        F.lit(None).cast("bigint").alias("quant_id"),
        as_numeric(-F.col("__short"), 18, 4).alias("quant_qty"),
        F.lit(None).cast("decimal(12,4)").alias("quant_cost"),
    )
    return taken.unionByName(missing)


def lot_moves(consumed: DataFrame, kit_lines: DataFrame) -> DataFrame:
    """``(quant_id, warehouse_id, receipt_id, delivery_id, leg, quant_qty, negative)``: which move took from which lot.

    Lots leave with the first leg of their delivery. A row without a lot is the negative quantity its move still owes.
    """
    place = kit_lines.select("delivery_id", *RECEIPT)
    return consumed.withColumnRenamed("demand_id", "delivery_id").join(place, "delivery_id").select(
        "quant_id", *RECEIPT, "delivery_id", F.lit(1).alias("leg"), "quant_qty", F.col("quant_id").isNull().alias("negative")
    )


def lot_changes(consumed: DataFrame, quants: DataFrame) -> DataFrame:
    """Change set ``(id, quantity)`` of the lots that were used: what is left of each, so that no later run uses it again."""
    used = consumed.filter(F.col("quant_id").isNotNull()).groupBy(F.col("quant_id").alias("id")).agg(F.sum("quant_qty").alias("__used"))
    left = as_numeric(F.col("quantity") - F.col("__used"), 18, 4)
    return quants.select("id", "quantity").join(used, "id").select("id", left.alias("quantity"))


def _places(warehouses: DataFrame, locations: DataFrame) -> DataFrame:
    """``(warehouse_id, stock, output, customer)`` places side by side."""
    return warehouses.select(
        F.col("id").alias("warehouse_id"),
        F.col("lot_stock_id").alias("stock"),
        F.col("wh_output_stock_loc_id").alias("output"),
        usage_location(locations, "customer").alias("customer"),
    )


def _routed(rows: DataFrame, warehouses: DataFrame, locations: DataFrame, picking_types: DataFrame) -> DataFrame:
    """Add the three places of centre and agent, and the outgoing picking type, to rows of a receipt."""
    places = _places(warehouses, locations)
    types = match_picking_type(
        places.select(
            "warehouse_id", F.lit("outgoing").alias("code"), F.col("stock").alias("source_id"), F.col("customer").alias("destination_id")
        ),
        picking_types,
    ).select("warehouse_id", "picking_type_id")
    own = places.join(types, "warehouse_id", "left").select("warehouse_id", "stock", "output", "picking_type_id")
    agent = places.select(
        F.col("warehouse_id").alias("agent_warehouse_id"), F.col("output").alias("agent_output"), F.col("customer").alias("agent_customer")
    )
    rows = attach(rows, own, {"warehouse_id": "warehouse_id"})
    return attach(rows, agent, {"agent_warehouse_id": "agent_warehouse_id"})


def _legs() -> Column:
    """The legs of a routed row: stock to output, output to the agent's output if that differs, output to customer."""
    transit = F.col("agent_warehouse_id") != F.col("warehouse_id")

    def leg(number: int, source: str, dest: str, state: str, following: Column) -> Column:
        return F.struct(
            F.lit(number).alias("leg"),
            F.col(source).alias("location_id"),
            F.col(dest).alias("location_dest_id"),
            F.lit(state).alias("state"),
            F.when(F.col(dest).isNotNull(), following).cast("int").alias("next_leg"),
        )

    legs = F.array(
        leg(1, "stock", "output", "done", F.when(transit, 2).otherwise(3)),
        leg(2, "output", "agent_output", "done", F.lit(3)),
        leg(3, "agent_output", "agent_customer", "assigned", F.lit(None)),
    )
    return F.explode(F.filter(legs, lambda x: (x["leg"] != 2) | transit))


def transfer_headers(
    totals: DataFrame,
    partners: DataFrame,
    warehouses: DataFrame,
    locations: DataFrame,
    picking_types: DataFrame,
    internal: Mapping[str, object],
    outgoing: Mapping[str, object],
    on_date: date,
) -> DataFrame:
    """One picking per receipt and leg; legs 1 and 2 share the ``internal`` counter, leg 3 has its own.

    Counters are ``{start, increment, prefix}``. The totals and the routed receipts are stored, as each numbering reads them twice.
    The routes of :func:`receipt_routes` are enough for numbered legs and their places; other columns come along if ``totals`` has them.
    """
    known = only_known(materialize(totals), partners, "partner_id")
    routed = materialize(_routed(known, warehouses, locations, picking_types))
    rows = routed.withColumn("l", _legs()).select("*", "l.*").drop("l")
    rows = rows.withColumn("__block", id_block("receipt_id"))

    def numbered(part: DataFrame, counter: Mapping[str, object]) -> DataFrame:
        return number_documents(part, ["receipt_id", "leg"], on_date=on_date, levels=["warehouse_id", "__block"], **counter)

    both = numbered(rows.filter(F.col("leg") < 3), internal).unionByName(numbered(rows.filter(F.col("leg") == 3), outgoing))
    has = set(totals.columns)
    return both.select(
        *RECEIPT,
        "leg",
        "document_no",
        F.col("document_name").alias("name"),
        *([F.col("order_name").alias("origin")] if "order_name" in has else []),
        *([F.concat(F.lit("sale,order,"), F.col("order_id").cast("string")).alias("ref")] if "order_id" in has else []),
        "partner_id",
        *[c for c in ("company_id",) if c in has],
        "picking_type_id",
        "location_id",
        "location_dest_id",
        "state",
        *[c for c in ("weight", "receipt_ref") if c in has],
        F.lit(on_date).alias("date"),
    )


def transfer_moves(
    kit_lines: DataFrame,
    totals: DataFrame,
    costs: DataFrame | None,
    partners: DataFrame,
    warehouses: DataFrame,
    locations: DataFrame,
    picking_types: DataFrame,
    on_date: date,
) -> DataFrame:
    """One move per delivered line and leg, keyed ``(warehouse_id, receipt_id, delivery_id, leg)``.

    ``costs`` gives the unit price, 0 where there is none. Of descriptive columns those come along that ``kit_lines`` has. ``move_dest_leg`` names the leg of the same line that goes on from where this one ends.
    """
    agent = totals.select(*RECEIPT, "agent_warehouse_id")
    rows = attach(only_known(kit_lines, partners, "partner_id"), agent, {c: c for c in RECEIPT})
    if costs is None:
        rows = rows.withColumn("line_cost", F.lit(None).cast("decimal(12,4)"))
    else:
        rows = rows.join(costs.select("order_line_id", "line_cost"), "order_line_id", "left")
    rows = _routed(rows, warehouses, locations, picking_types).withColumn("l", _legs()).select("*", "l.*").drop("l")
    lacking = _DESCRIPTIVE - set(kit_lines.columns)
    columns = {
        **{c: c for c in (*RECEIPT, "delivery_id", "leg", "order_line_id", "product_id")},
        "name": "product_name",
        "product_uom": "product_uom",
        "product_qty": "product_uom_qty",
        "ordered_qty": "ordered_qty",
        "price_unit": F.coalesce("line_cost", F.lit(0).cast("decimal(12,4)")),
        **{c: c for c in ("company_id", "partner_id", "picking_type_id", "location_id", "location_dest_id", "state")},
        "origin": "order_name",
        "weight": "weight",
        "date_expected": "date_expected",
        "date": F.lit(on_date),
        "move_dest_leg": "next_leg",
    }
    return rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items() if n == "date" or n == "price_unit" or c not in lacking])


def chain_moves(moves: DataFrame) -> DataFrame:
    """``(warehouse_id, receipt_id, delivery_id, leg, next_leg)`` of transfer moves from any source.

    The successor is the move of the same delivered line that starts where this one ends.
    """
    key = [*RECEIPT, "delivery_id"]
    heads = moves.select(*key, F.col("leg").alias("next_leg"), F.col("location_id").alias("location_dest_id"))
    joined = moves.select(*key, "leg", "location_dest_id").join(heads, [*key, "location_dest_id"])
    return joined.filter(F.col("leg") != F.col("next_leg")).select(*key, "leg", "next_leg")


def delivery_changes(deliveries: DataFrame, headers: DataFrame) -> DataFrame:
    """Change set closing the deliveries of receipts that got transfers, with the numbers of their pickings."""
    names = headers.groupBy(*RECEIPT).agg(
        *[
            F.max(F.when(F.col("leg") == leg, F.col("name"))).alias(out)
            for leg, out in ((1, "picking_int"), (2, "transit_int"), (3, "picking_out"))
        ]
    )
    return deliveries.filter(unprocessed()).join(names, RECEIPT).select(
        "id", F.lit(True).alias("processed"), F.lit(DONE_REMARK).alias("remarks"), "picking_int", "transit_int", "picking_out"
    )
