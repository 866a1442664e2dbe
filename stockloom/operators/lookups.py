"""Lookups against reference data, answered for all rows at once.

Joins carry no broadcast hints: adaptive execution broadcasts a side only after it has measured it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import property_key, reference_text
from stockloom.operators.joins import attach
from stockloom.session import materialize

#: Locations found by their usage alone.
USAGE_TYPES = ("customer", "supplier", "procurement", "production")
#: Scrap-like locations, found by usage ``inventory`` and their name.
INVENTORY_NAMES = {"loss": "Inventory loss", "Inventory loss": "Inventory loss", "Scrapped": "Scrapped"}
#: Locations that are columns of the warehouse.
WAREHOUSE_COLUMNS = {"stock": "lot_stock_id", "output": "wh_output_stock_loc_id", "input": "wh_input_stock_loc_id"}
LOCATION_TYPES = (*USAGE_TYPES, *INVENTORY_NAMES, *WAREHOUSE_COLUMNS)


def location_closure(locations: DataFrame, ancestors: DataFrame | None = None) -> DataFrame:
    """All ``(ancestor_id, descendant_id)`` pairs of a nested-set tree, each node included in its own subtree.

    The interval of an ancestor is cut into aligned blocks of sizes 1, 16, 256, …; a node lies in exactly one block
    of each size, so containment becomes an equi-join whose output is the closure itself. ``ancestors`` (column
    ``id``) restricts the left side. Nested-set numbers may be any integers below ``2 ** 62``.
    """
    tops = locations.select(F.col("id").alias("ancestor_id"), "parent_left", "parent_right")
    if ancestors is not None:
        wanted = ancestors.select(F.col("id").alias("ancestor_id")).filter(F.col("ancestor_id").isNotNull())
        tops = tops.join(wanted, "ancestor_id", "left_semi")
    cover = tops.select("ancestor_id", F.explode(_cover_blocks()).alias("c"))
    nodes = locations.select(F.col("id").alias("descendant_id"), "name", "complete_name", F.explode(_held_blocks()).alias("c"))
    return (
        cover.select("ancestor_id", "c.size", "c.block")
        .join(nodes.select("descendant_id", "name", "complete_name", "c.size", "c.block"), ["size", "block"])
        .select("ancestor_id", "descendant_id", "name", "complete_name")
    )


#: Binary logarithms of the block sizes; sixteen blocks of the largest one span all 64-bit numbers.
_SHIFTS = ", ".join(str(shift) for shift in range(0, 64, 4))


def _cover_blocks() -> Column:
    """The aligned blocks that together make up ``parent_left .. parent_right``, at most 30 per size.

    Per size the blocks ``low .. high - 1`` lie inside the interval; those between the next larger boundaries ``up``
    and ``down`` are left to the larger size. The largest size keeps all its blocks.
    """
    return F.expr(
        f"""
        flatten(transform(
          transform(
            transform(array({_SHIFTS}), s -> named_struct('s', s,
              'low', shiftright(parent_left, s) + CASE WHEN (parent_left & (shiftleft(1L, s) - 1)) = 0 THEN 0L ELSE 1L END,
              'high', shiftright(parent_right, s) + CASE WHEN (~parent_right & (shiftleft(1L, s) - 1)) = 0 THEN 1L ELSE 0L END)),
            e -> named_struct('s', e.s, 'low', e.low, 'high', e.high,
              'up', shiftleft(shiftright(e.low + 15, 4), 4), 'down', shiftleft(shiftright(e.high, 4), 4))),
          e -> transform(
            CASE WHEN e.low >= e.high THEN cast(array() as array<bigint>)
                 WHEN e.up >= e.down OR e.s = 60 THEN sequence(e.low, e.high - 1)
                 ELSE concat(
                   CASE WHEN e.low < e.up THEN sequence(e.low, e.up - 1) ELSE cast(array() as array<bigint>) END,
                   CASE WHEN e.down < e.high THEN sequence(e.down, e.high - 1) ELSE cast(array() as array<bigint>) END)
            END,
            b -> named_struct('size', e.s, 'block', b))))
        """
    )


def _held_blocks() -> Column:
    """The block of each size that holds ``parent_left``."""
    return F.expr(f"transform(array({_SHIFTS}), s -> named_struct('size', s, 'block', shiftright(parent_left, s)))")


def warehouse_locations(warehouses: DataFrame, locations: DataFrame) -> DataFrame:
    """Long table ``(warehouse_id, location_type, location_id)`` of every known type; unknown places are NULL."""
    by_usage = (
        locations.filter(F.col("usage").isin(*USAGE_TYPES)).groupBy(F.col("usage").alias("kind")).agg(F.min("id").alias("found"))
    )
    by_name = (
        locations.filter((F.col("usage") == "inventory") & F.col("name").isin(*set(INVENTORY_NAMES.values())))
        .groupBy(F.col("name").alias("kind"))
        .agg(F.min("id").alias("found"))
    )
    # At most six rows: one per fixed usage or name.
    virtual = F.broadcast(by_usage.unionByName(by_name))

    entries = [F.struct(F.lit(t).alias("location_type"), F.lit(t).alias("kind"), F.lit(None).cast("bigint").alias("own")) for t in USAGE_TYPES]
    entries += [
        F.struct(F.lit(t).alias("location_type"), F.lit(k).alias("kind"), F.lit(None).cast("bigint").alias("own"))
        for t, k in INVENTORY_NAMES.items()
    ]
    entries += [
        F.struct(F.lit(t).alias("location_type"), F.lit(None).cast("string").alias("kind"), F.col(c).cast("bigint").alias("own"))
        for t, c in WAREHOUSE_COLUMNS.items()
    ]
    long = warehouses.select(F.col("id").alias("warehouse_id"), F.explode(F.array(*entries)).alias("e"))
    return (
        long.select("warehouse_id", "e.location_type", "e.kind", "e.own")
        .join(virtual, "kind", "left")
        .select("warehouse_id", "location_type", F.coalesce("own", "found").alias("location_id"))
    )


def only_known(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is an id of ``table``.

    The ids that occur and are known are stored first. Where many rows share few ids they are a small table of known
    size, which planning broadcasts, so that the rows of a frequent id are not brought together in one task. ``rows`` are
    read twice, so stored ones are best.
    """
    named = rows.select(column).distinct()
    known = materialize(named.join(table.select(F.col("id").alias(column)), column, "left_semi"))
    return rows.join(known, column, "left_semi")


def usage_location(locations: DataFrame, usage: str) -> Column:
    """The first place of a usage, as a scalar subquery."""
    return locations.filter(F.col("usage") == usage).agg(F.min("id")).scalar()


def locations_of_type(warehouses: DataFrame, locations: DataFrame, location_type: str) -> DataFrame:
    """``(warehouse_id, location_id)`` for one location type; no join is needed for any of them."""
    if location_type in WAREHOUSE_COLUMNS:
        place = F.col(WAREHOUSE_COLUMNS[location_type])
    elif location_type in USAGE_TYPES:
        place = usage_location(locations, location_type)
    elif location_type in INVENTORY_NAMES:
        named = locations.filter(F.col("name") == INVENTORY_NAMES[location_type])
        place = usage_location(named, "inventory")
    else:
        place = F.lit(None)
    return warehouses.select(F.col("id").alias("warehouse_id"), place.cast("bigint").alias("location_id"))


def match_picking_type(requests: DataFrame, picking_types: DataFrame) -> DataFrame:
    """Add ``picking_type_id`` to rows with ``warehouse_id, code, source_id, destination_id``.

    A NULL default place of a type accepts any place; NULL request values match nothing. The smallest id wins.
    """
    columns = ["warehouse_id", "code", "source_id", "destination_id"]
    types = picking_types.filter("active").select(
        "warehouse_id",
        "code",
        F.col("id").alias("picking_type_id"),
        F.col("default_location_src_id").alias("__src"),
        F.col("default_location_dest_id").alias("__dest"),
    )
    found = (
        requests.select(*columns)
        .distinct()
        .join(types, ["warehouse_id", "code"])
        .filter(
            (F.coalesce("__src", "source_id") == F.col("source_id"))
            & (F.coalesce("__dest", "destination_id") == F.col("destination_id"))
        )
        .groupBy(*columns)
        .agg(F.min("picking_type_id").alias("picking_type_id"))
    )
    return requests.join(found, columns, "left")


def stocked_products(ofc_locations: DataFrame, location_products: DataFrame) -> DataFrame:
    """Distinct ``(warehouse_id, product_id)`` with a place assigned."""
    places = ofc_locations.select(F.col("id").alias("location_id"), "warehouse_id")
    return location_products.join(places, "location_id").select("warehouse_id", "product_id").distinct()


def fulfilment_center(
    rows: DataFrame, warehouses: DataFrame, stocked: DataFrame, warehouse: str = "warehouse_id", out: str = "ofc_id"
) -> DataFrame:
    """Add the centre that ships: the warehouse itself if it has no parent or stocks the product, else its parent."""
    parents = warehouses.select(F.col("id").alias("__w"), F.col("parent_warehouse_id").alias("__parent"))
    held = stocked.select("warehouse_id", "product_id").distinct().withColumn("__held", F.lit(True))
    found = attach(
        rows.join(parents, F.col(warehouse) == F.col("__w"), "left"),
        held.select(F.col("warehouse_id").alias("__sw"), F.col("product_id").alias("__sp"), "__held"),
        {warehouse: "__sw", "product_id": "__sp"},
    )
    centre = F.when(F.col("__held").isNull(), F.coalesce("__parent", warehouse)).otherwise(F.col(warehouse))
    return found.withColumn(out, centre).drop("__w", "__parent", "__held")


def item_location(
    rows: DataFrame,
    ofc_locations: DataFrame,
    location_products: DataFrame,
    warehouse: str = "ofc_id",
    out: str = "ofc_location_id",
) -> DataFrame:
    """Add the place of the product inside the warehouse, else the default place of the warehouse."""
    places = ofc_locations.select(F.col("id").alias("location_id"), F.col("warehouse_id").alias("__w"), "is_default")
    defaults = places.filter("is_default").groupBy(F.col("__w").alias("__dw")).agg(F.min("location_id").alias("__default"))
    assigned = (
        location_products.join(places, "location_id")
        .groupBy("__w", F.col("product_id").alias("__p"))
        .agg(F.min("location_id").alias("__assigned"))
    )
    found = attach(rows, assigned, {warehouse: "__w", "product_id": "__p"})
    found = attach(found, defaults, {warehouse: "__dw"})
    return found.withColumn(out, F.coalesce("__assigned", "__default")).drop("__assigned", "__default")


#: Property kinds: typed column of the record and type of the result.
PROPERTY_KINDS = {
    "value": ("value_reference", "int"),
    "text": ("value_text", "string"),
    "integer": ("value_integer", "int"),
    "float": ("value_float", "double"),
    "datetime": ("value_datetime", "date"),
}


def resolve_property(
    rows: DataFrame,
    properties: DataFrame,
    name: str,
    model: str,
    record_id: str,
    kind: str = "value",
    target: str | None = None,
    out: str = "property",
) -> DataFrame:
    """Add a property of a record; NULL or empty values fall back to the default entry (``res_id`` NULL).

    Defaults of all typed kinds come from the text column; references use the reference column both times.
    """
    column, result = PROPERTY_KINDS[kind]
    fallback = column if kind == "value" else "value_text"

    def clean(col: Column) -> Column:
        return reference_text(col, target) if target else col

    named = properties.filter(F.col("name") == name)
    own = (
        named.filter(F.col("res_id").isNotNull())
        .groupBy(F.col("res_id").alias("__key"))
        .agg(F.min(F.col(column).cast("string")).alias("__own"))
    )
    default = named.filter(F.col("res_id").isNull()).agg(F.min(clean(F.col(fallback)))).scalar()
    value = F.coalesce(F.nullif(clean(F.col("__own")), F.lit("")), default)
    keyed = rows.withColumn("__record", property_key(model, record_id))
    return attach(keyed, own, {"__record": "__key"}).withColumn(out, value.try_cast(result)).drop("__record", "__own")


def client_vendor(orders: DataFrame) -> DataFrame:
    """``(customer_id, vendor_id)``: the agent of customers who ever ordered through exactly one, else NULL."""
    low, high = F.min("partner_id"), F.max("partner_id")
    return orders.groupBy("customer_id").agg(F.when(low == high, low).alias("vendor_id"))


def look_up(rows: DataFrame, table: DataFrame, on: str, value: str, out: str, key: str = "id") -> DataFrame:
    """Add one column of a reference table by its primary key (account type, company currency, partner, …)."""
    side = table.select(F.col(key).alias("__key"), F.col(value).alias(out))
    return rows.join(side, F.col(on) == F.col("__key"), "left").drop("__key")


def account_type(rows: DataFrame, accounts: DataFrame, on: str = "account_id", out: str = "user_type_id") -> DataFrame:
    return look_up(rows, accounts, on, "user_type_id", out)


def default_currency(rows: DataFrame, companies: DataFrame, on: str = "company_id", out: str = "currency_id") -> DataFrame:
    return look_up(rows, companies, on, "currency_id", out)


def journal_account(journals: DataFrame, code: str) -> Column:
    """Default account of a journal, as a scalar subquery."""
    return journals.filter(F.col("code") == code).agg(F.min_by("default_debit_account_id", "id")).scalar()


def agent_warehouse(rows: DataFrame, partners: DataFrame, agent: str = "partner_id", out: str = "warehouse_id") -> DataFrame:
    """Add the warehouse of an agent; agent 0 belongs to warehouse 1."""
    found = look_up(rows, partners, agent, "warehouse_id", "__found")
    return found.withColumn(out, F.when(F.col(agent) == 0, F.lit(1)).otherwise(F.col("__found"))).drop("__found")


def product_matrix(
    warehouses: DataFrame, warehouse_products: DataFrame, products: DataFrame, templates: DataFrame
) -> DataFrame:
    """Stocked, saleable products per warehouse with the parent warehouse."""
    saleable = (
        templates.filter("sale_ok")
        .select(F.col("id").alias("product_tmpl_id"), F.col("name").alias("product_name"))
        .join(products.select(F.col("id").alias("product_id"), "product_tmpl_id"), "product_tmpl_id")
        .select("product_id", "product_name")
    )
    own = warehouses.select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"), "parent_warehouse_id")
    parents = warehouses.select(F.col("id").alias("parent_warehouse_id"), F.col("name").alias("parent_name"))
    return (
        warehouse_products.select("warehouse_id", "product_id")
        .distinct()
        .join(saleable, "product_id")
        .join(own, "warehouse_id")
        .join(parents, "parent_warehouse_id", "left")
        .select("warehouse_id", "warehouse_name", "parent_warehouse_id", "parent_name", "product_id", "product_name")
    )


def enrich_lines(
    lines: DataFrame, orders: DataFrame, products: DataFrame, templates: DataFrame, partners: DataFrame
) -> DataFrame:
    """Copy order name, template, category, commission tier, agent type and route onto order lines."""
    order_names = orders.select(F.col("id").alias("order_id"), F.col("name").alias("order_name"), "partner_id")
    kinds = products.select(F.col("id").alias("product_id"), "product_tmpl_id").join(
        templates.select(F.col("id").alias("product_tmpl_id"), "commissiontier_id", "categ_id"), "product_tmpl_id", "left"
    )
    rows = lines.join(order_names, "order_id", "left").join(kinds, "product_id", "left")
    rows = look_up(rows, partners, "order_partner_id", "agent_type_id", "agent_type_id")
    return look_up(rows, partners, "partner_id", "route_id", "route_id")
