"""Stock balances over subtrees of the location tree."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import as_numeric, dash_label
from stockloom.operators.joins import attach
from stockloom.operators.lookups import agent_warehouse, fulfilment_center, locations_of_type
from stockloom.session import materialize

PENDING_STATES = ("assigned", "confirmed")
OPEN_ORDER_STATES = ("draft", "progress")


def subtree_flows(moves: DataFrame, uoms: DataFrame, closure: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """In- and out-flow per ``(location_id, product_id, product_uom)`` over the subtree of each closure ancestor.

    ``by`` names further columns of the moves that keep flows apart. The closure is read several times, so a stored one is best.

    Moves inside a subtree, or with an unknown place, count in neither direction. A subtree holds both ends of a move
    exactly if it holds the lowest place above both, so a move is three marks: what comes in at its destination, what goes
    out at its source, and both taken back at the lowest common place. Marks add up per node before the tree is asked;
    the flow of a subtree is the sum of the marks of its nodes. So neither moves nor pairs of places are multiplied by the
    depth of the tree, only nodes that hold a product are. The lowest common place is looked up once per pair of places, so
    the flows of a place that very many moves share are neither gathered by it nor carry paths; the pairs are stored, as they are
    read twice.
    """
    pairs = (
        moves.filter(F.col("location_id").isNotNull() & F.col("location_dest_id").isNotNull())
        .filter(F.col("location_id") != F.col("location_dest_id"))
        .groupBy("product_id", "product_uom", *by, "location_id", "location_dest_id")
        .agg(F.sum("product_qty").alias("qty"))
        .join(uoms.select(F.col("id").alias("product_uom"), "factor"), "product_uom")
        .withColumn("qty", F.col("qty") / F.col("factor"))
    )
    pairs, ends = materialize(pairs), ["location_id", "location_dest_id"]
    pairs = attach(pairs, _common_places(pairs.select(*ends).distinct(), closure), {c: c for c in ends})

    def mark(node: str, into: int, out: int):
        flow = lambda sign: F.lit(sign) * F.col("qty")
        return F.struct(
            F.col(node).alias("node"), flow(into).alias("in"), flow(out).alias("out"), F.lit(into).alias("ins"), F.lit(out).alias("outs")
        )

    marks = F.array(mark("location_dest_id", 1, 0), mark("location_id", 0, 1), mark("common_id", -1, -1))
    amounts, keys = ("in", "out", "ins", "outs"), ["product_id", "product_uom", *by]
    marked = pairs.select(*keys, F.explode(marks).alias("m")).select(*keys, "m.*").filter(F.col("node").isNotNull())
    marked = marked.groupBy(*keys, "node").agg(*[F.sum(c).alias(c) for c in amounts])
    above = closure.select(F.col("ancestor_id").alias("location_id"), F.col("descendant_id").alias("node"))
    flows = marked.join(above, "node").groupBy("location_id", *keys).agg(*[F.sum(c).alias(c) for c in amounts])
    has_in, has_out = F.col("ins") > 0, F.col("outs") > 0
    return flows.filter(has_in | has_out).select(
        "location_id",
        *keys,
        F.when(has_in, F.col("in")).alias("qty_in"),
        F.when(has_out, F.col("out")).alias("qty_out"),
        has_in.alias("has_in"),
        has_out.alias("has_out"),
    )


def _common_places(lanes: DataFrame, closure: DataFrame) -> DataFrame:
    """``(location_id, location_dest_id, common_id)``: the lowest place above both ends of each pair of places."""
    paths = paths_from_top(closure)
    for end, path in (("location_id", "__from"), ("location_dest_id", "__to")):
        lanes = attach(lanes, paths.select(F.col("node").alias("end"), F.col("path").alias(path)), {end: "end"})
    # both paths begin alike; the last place they share is the lowest above both
    common = F.try_element_at(F.array_intersect("__from", "__to"), F.lit(-1))
    return lanes.select("location_id", "location_dest_id", common.alias("common_id"))


def paths_from_top(closure: DataFrame) -> DataFrame:
    """``(node, path)``: the closure ancestors of each node from the highest to the lowest, which has the most ancestors itself."""
    up = closure.select("ancestor_id", "descendant_id")
    depth = up.groupBy(F.col("descendant_id").alias("ancestor_id")).agg(F.count(F.lit(1)).alias("depth"))
    steps = F.sort_array(F.collect_list(F.struct("depth", "ancestor_id")))
    paths = up.join(depth, "ancestor_id").groupBy(F.col("descendant_id").alias("node")).agg(steps.alias("steps"))
    return paths.select("node", F.col("steps.ancestor_id").alias("path"))


def _net(flows: DataFrame, name: str) -> DataFrame:
    """Net per location and product; 0 where nothing ever came in, whatever went out."""
    net = F.coalesce(F.sum("qty_in"), F.lit(0)) - F.coalesce(F.sum("qty_out"), F.lit(0))
    return flows.groupBy("location_id", "product_id").agg(
        as_numeric(F.when(F.bool_or("has_in"), net).otherwise(0), 12, 2).alias(name)
    )


def qty_on_hand(moves: DataFrame, uoms: DataFrame, closure: DataFrame) -> DataFrame:
    """``(location_id, product_id, qty_on_hand)`` of done moves."""
    return _net(subtree_flows(moves.filter(F.col("state") == "done"), uoms, closure), "qty_on_hand")


def pending_in(moves: DataFrame, uoms: DataFrame, closure: DataFrame, pickings: DataFrame) -> DataFrame:
    """``(location_id, product_id, pending_in)`` of assigned and confirmed moves of incoming pickings."""
    incoming = pickings.filter(F.col("type") == "in").select(F.col("id").alias("picking_id"))
    waiting = moves.filter(F.col("state").isin(*PENDING_STATES)).join(incoming, "picking_id", "left_semi")
    return _net(subtree_flows(waiting, uoms, closure), "pending_in")


def stock_and_pending_in(moves: DataFrame, uoms: DataFrame, closure: DataFrame, pickings: DataFrame) -> DataFrame:
    """``(location_id, product_id, qty_on_hand, pending_in)``: both balances from one pass over the moves."""
    incoming = pickings.filter(F.col("type") == "in").select(F.col("id").alias("picking_id")).distinct()
    waiting = F.col("state").isin(*PENDING_STATES)
    known = moves.filter((F.col("state") == "done") | waiting).join(incoming.withColumn("__incoming", F.lit(True)), "picking_id", "left")
    kind = F.when(F.col("state") == "done", "done").when(F.col("__incoming"), "pending")
    flows = subtree_flows(known.withColumn("kind", kind).filter(F.col("kind").isNotNull()), uoms, closure, ["kind"])

    def net(of: str, name: str) -> Column:
        own = lambda c: F.when(F.col("kind") == of, F.col(c))
        balance = F.coalesce(F.sum(own("qty_in")), F.lit(0)) - F.coalesce(F.sum(own("qty_out")), F.lit(0))
        return as_numeric(F.when(F.bool_or(own("has_in")), balance).otherwise(0), 12, 2).alias(name)

    return flows.groupBy("location_id", "product_id").agg(net("done", "qty_on_hand"), net("pending", "pending_in"))


def stock_flow_report(moves: DataFrame, uoms: DataFrame, closure: DataFrame, products: DataFrame) -> DataFrame:
    """On-hand report per location and product code: net, in and out.

    In- and out-flow stay grouped by unit and are paired per product only, so each in-unit meets each out-unit; a
    product needs both directions to appear. A code shared by products shows the first active one.
    """
    flows = subtree_flows(moves.filter(F.col("state") == "done"), uoms, closure)
    keys = ["location_id", "product_id"]
    totals = flows.groupBy(*keys).agg(
        F.sum("qty_in").alias("qty_in"),
        F.sum("qty_out").alias("qty_out"),
        F.count_if("has_in").alias("in_units"),
        F.count_if("has_out").alias("out_units"),
    )
    first = (
        products.filter("active")
        .filter(F.col("default_code").isNotNull())
        .groupBy("default_code")
        .agg(F.min_by(F.struct("id", "name"), "id").alias("p"))
        .select(F.col("p.id").alias("product_id"), "default_code", F.col("p.name").alias("name"))
    )
    # Pairing m in-rows with n out-rows repeats each in-row n times and each out-row m times.
    repeated_in, repeated_out = F.col("qty_in") * F.col("out_units"), F.col("qty_out") * F.col("in_units")
    return (
        totals.filter((F.col("in_units") > 0) & (F.col("out_units") > 0))
        .join(first, "product_id")
        .select(
            *keys,
            "default_code",
            "name",
            as_numeric(repeated_in - repeated_out, 18, 2).alias("qoh"),
            as_numeric(repeated_in, 18, 2).alias("qty_in"),
            as_numeric(repeated_out, 18, 2).alias("qty_out"),
        )
    )


def pending_out(orders: DataFrame, lines: DataFrame, partners: DataFrame, as_of: date) -> DataFrame:
    """``(warehouse_id, product_id, pending_out)``: open demand delivered after ``as_of``.

    The warehouse is the partner whose id equals it, as the rule has always been applied.
    """
    waiting = orders.filter(
        F.col("state").isin(*OPEN_ORDER_STATES)
        & (F.col("date_delivery") > F.lit(as_of))
        & (F.col("date_order") <= F.lit(as_of))
    ).select(F.col("id").alias("order_id"), "partner_id")
    known = waiting.join(partners.select(F.col("id").alias("partner_id")), "partner_id", "left_semi")
    return (
        lines.filter(F.col("product_id").isNotNull())
        .select("order_id", "product_id", "product_uom_qty")
        .join(known, "order_id")
        .groupBy(F.col("partner_id").alias("warehouse_id"), "product_id")
        .agg(as_numeric(F.sum("product_uom_qty"), 12, 2).alias("pending_out"))
    )


def available_qoh(on_hand: DataFrame, demand: DataFrame, warehouses: DataFrame, locations: DataFrame) -> DataFrame:
    """``(warehouse_id, product_id, available_qoh)``: on hand at the stock place less pending demand."""
    stock = locations_of_type(warehouses, locations, "stock")
    held = on_hand.join(stock, "location_id").select("warehouse_id", "product_id", "qty_on_hand")
    return held.join(demand, ["warehouse_id", "product_id"], "full_outer").select(
        "warehouse_id",
        "product_id",
        as_numeric(F.coalesce("qty_on_hand", F.lit(0)) - F.coalesce("pending_out", F.lit(0)), 12, 2).alias("available_qoh"),
    )


def _with_available(pairs: DataFrame, available: DataFrame) -> DataFrame:
    return pairs.join(available, ["warehouse_id", "product_id"], "left").withColumn(
        "available_qoh", F.coalesce("available_qoh", F.lit(0).cast("decimal(12,2)"))
    )


def available_for_pairs(pairs: DataFrame, available: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Available quantity of the requested ``(warehouse_id, product_id)`` pairs, zeros kept."""
    named = warehouses.select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"))
    return _with_available(pairs.select("warehouse_id", "product_id").distinct().join(named, "warehouse_id"), available)


def available_by_warehouse(product_ids: Sequence[int], available: DataFrame, warehouses: DataFrame) -> DataFrame:
    """One row per warehouse for each named product, zeros kept."""
    wanted = F.explode(F.array(*[F.lit(p).cast("bigint") for p in product_ids]))
    return _with_available(
        warehouses.select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"), wanted.alias("product_id")),
        available,
    )


def expected_qoh(
    requests: DataFrame, partners: DataFrame, warehouses: DataFrame, stocked: DataFrame, available: DataFrame
) -> DataFrame:
    """Add ``ofc_id`` and ``expected_qoh`` to rows ``(partner_id, product_id)``: what the agent's centre can ship."""
    centred = fulfilment_center(agent_warehouse(requests, partners), warehouses, stocked)
    side = available.select(F.col("warehouse_id").alias("ofc_id"), "product_id", F.col("available_qoh").alias("expected_qoh"))
    return centred.join(side, ["ofc_id", "product_id"], "left").select(
        *requests.columns,
        "warehouse_id",
        "ofc_id",
        F.coalesce("expected_qoh", F.lit(0).cast("decimal(12,2)")).alias("expected_qoh"),
    )


def _line_id(product: Column) -> Column:
    return F.concat(F.lit("product_"), product.cast("string"))


def stock_per_location(
    quants: DataFrame,
    products: DataFrame,
    templates: DataFrame,
    locations: DataFrame,
    product_id: int | None = None,
    unfolded: Sequence[int] | None = None,
) -> DataFrame:
    """Report lines: level 2 per product, level 4 per product and internal place, level 0 the grand total.

    ``product_id`` drills down to one product and leaves the total out. ``unfolded`` restricts the level 4 lines to
    those products; by default all are shown.
    """
    if product_id is not None:
        quants = quants.filter(F.col("product_id") == product_id)
    named = products.select(F.col("id").alias("product_id"), "product_tmpl_id", "default_code").join(
        templates.select(F.col("id").alias("product_tmpl_id"), F.col("name").alias("template_name")), "product_tmpl_id"
    ).select("product_id", dash_label("default_code", "template_name").alias("product_name"))
    internal = locations.filter(F.col("usage") == "internal").select(
        F.col("id").alias("location_id"), F.col("complete_name").alias("location")
    )
    balance = (
        quants.groupBy("product_id", "location_id")
        .agg(F.sum("quantity").alias("qty"))
        .filter(F.col("qty") != 0)
        .join(internal, "location_id")
        .join(named, "product_id")
        .select("product_id", "product_name", "location_id", "location", "qty")
    )
    sets = [["product_id", "product_name", "location_id", "location"], ["product_id", "product_name"]]
    if product_id is None:
        sets.append([])
    group = ["product_id", "product_name", "location_id", "location"]
    rolled = balance.groupingSets([[F.col(c) for c in s] for s in sets], *group).agg(
        as_numeric(F.sum("qty"), 18, 2).alias("qty"),
        F.grouping("location_id").alias("__no_place"),
        F.grouping("product_id").alias("__no_product"),
    )
    level = F.when(F.col("__no_product") == 1, 0).when(F.col("__no_place") == 1, 2).otherwise(4)
    lines = rolled.select(
        level.alias("level"),
        F.when(level == 0, F.lit("grouped_products_total"))
        .when(level == 2, _line_id(F.col("product_id")))
        .otherwise(F.col("location_id").cast("string"))
        .alias("line_id"),
        F.when(level == 4, _line_id(F.col("product_id"))).alias("parent_id"),
        "product_id",
        F.when(level == 0, F.lit("Total")).when(level == 2, F.col("product_name")).otherwise(F.col("location")).alias("name"),
        "location_id",
        "qty",
    )
    if unfolded is not None:
        lines = lines.filter((F.col("level") != 4) | F.col("product_id").isin(*unfolded))
    return lines
