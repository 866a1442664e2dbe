"""Invoices of delivered receipts with inclusive tax, and their balanced journal lines."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, functions as F

from stockloom.functions.scalars import (
    as_int,
    as_money,
    as_numeric,
    posting_name,
    posting_reference,
    tax_amount,
)
from stockloom.operators.intake import RECEIPT, live_documents
from stockloom.operators.joins import attach
from stockloom.operators.lookups import account_type, default_currency, journal_account, resolve_property
from stockloom.operators.maintenance import number_documents
from stockloom.operators.ordered import id_block
from stockloom.session import materialize

# Journal of sales and the property of the receivable account.
SALES_JOURNAL = "INV"
RECEIVABLE_PROPERTY = "property_account_receivable_id"
LINE_KEY = [*RECEIPT, "order_line_id"]


def receipt_orders(deliveries: DataFrame) -> DataFrame:
    """Leading delivery (smallest id) per receipt: order, user, reference and delivery date."""
    lead = F.min_by(F.struct("order_id", "user_id", "receipt_ref", F.coalesce("date_delivery", "date").alias("delivery_date")), "id")
    return deliveries.groupBy(*RECEIPT).agg(lead.alias("d")).select(*RECEIPT, "d.*")


def receipt_order_ids(deliveries: DataFrame) -> DataFrame:
    """``(warehouse_id, receipt_id, order_id)`` of :func:`receipt_orders` alone, without its wide leading row."""
    return deliveries.groupBy(*RECEIPT).agg(F.min_by("order_id", "id").alias("order_id"))


def delivered_lines(
    receipts: DataFrame, moves: DataFrame, lines: DataFrame, products: DataFrame, templates: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Lines to invoice before tax: first-leg quantity per receipt and order line, of receipts not yet invoiced.

    Several deliveries of a line in one receipt add up; lines without quantity drop out. Moves meet their receipt first, as
    they are added up by keys that begin with it. Lines that bring ``product_tmpl_id`` were joined with their products already.
    """
    fresh = receipts.select(*RECEIPT, "order_id").join(live_documents(invoices), RECEIPT, "left_anti")
    moved = (
        moves.filter(F.col("leg") == 1)
        .select(*LINE_KEY, "product_id", "product_qty")
        .join(fresh, RECEIPT)
        .groupBy(*LINE_KEY, "product_id", "order_id")
        .agg(as_int(F.sum("product_qty")).alias("quantity"))
        .filter(F.col("quantity") != 0)
    )
    templates = templates.select(F.col("id").alias("product_tmpl_id"), "categ_id")
    brought = [c for c in lines.columns if c == "product_tmpl_id"]
    ordered = lines.select(
        F.col("id").alias("order_line_id"),
        "order_id",
        "product_id",
        F.col("name").alias("product_name"),
        "product_uom",
        as_numeric("price_unit", 10, 2).alias("price_unit"),
        *brought,
    )
    rows = moved.join(ordered, ["order_line_id", "order_id", "product_id"])
    if brought:
        return rows.join(templates, "product_tmpl_id")
    known = products.select(F.col("id").alias("product_id"), "product_tmpl_id").join(templates, "product_tmpl_id")
    return rows.join(known, "product_id")


def line_taxes(delivered: DataFrame, product_taxes: DataFrame, taxes: DataFrame) -> DataFrame:
    """Tax rows per invoice line; the rates of all taxes of a product are included in its price.

    An inactive tax keeps its row but has no rate and no amount.
    """
    active = taxes.filter("active").select(
        F.col("id").alias("tax_id"),
        F.col("name").alias("tax_name"),
        F.col("amount_type").alias("kind"),
        as_numeric("amount", 12, 6).alias("rate"),
        F.col("account_id").alias("tax_account_id"),
    )
    rated = product_taxes.select(F.col("prod_id").alias("product_tmpl_id"), "tax_id").join(active, "tax_id", "left")
    per_product = rated.groupBy("product_tmpl_id").agg(
        as_numeric(F.sum("rate"), 12, 6).alias("total_rate"),
        F.collect_list(F.struct("tax_id", "tax_name", "kind", "rate", "tax_account_id")).alias("__taxes"),
    )
    rows = attach(delivered, per_product, {"product_tmpl_id": "product_tmpl_id"}).filter(F.col("__taxes").isNotNull())
    rows = rows.withColumn("t", F.explode("__taxes"))
    amount = tax_amount(as_money("price_unit"), "quantity", F.col("t.rate"), "total_rate", F.col("t.kind"))
    return rows.select(*LINE_KEY, "product_id", "t.*", "total_rate", amount.alias("tax_amount"))


def invoice_lines(delivered: DataFrame, tax_rows: DataFrame) -> DataFrame:
    """Invoice lines with tax, subtotal and commission (no tier ever fills its rate, so it is 0)."""
    summed = tax_rows.groupBy(*LINE_KEY).agg(F.sum("tax_amount").alias("__tax"))
    rows = delivered.join(summed, LINE_KEY, "left")
    rows = rows.withColumn("tax", as_numeric(F.coalesce("__tax", F.lit(0)), 10, 2))
    gross = F.col("price_unit") * F.col("quantity")
    return rows.select(
        *LINE_KEY,
        "order_id",
        "product_id",
        "product_name",
        "product_uom",
        "price_unit",
        "quantity",
        "tax",
        as_numeric(gross, 12, 2).alias("gross"),
        as_numeric(gross - F.col("tax"), 10, 2).alias("price_subtotal"),
        F.lit(0).cast("decimal(10,2)").alias("commission"),
    )


def invoice_headers(
    inv_lines: DataFrame,
    receipts: DataFrame,
    orders: DataFrame,
    companies: DataFrame,
    properties: DataFrame,
    counter: Mapping[str, object],
    on_date: date,
) -> DataFrame:
    """One numbered invoice per receipt; totals from its lines, date of delivery or of the order.

    The invoices are stored before they are numbered, as the numbering reads them twice. So are the accounts of the partners
    that orders name: where many invoices share few partners, planning broadcasts them.
    """
    totals = inv_lines.groupBy(*RECEIPT).agg(
        as_numeric(F.sum("gross"), 12, 2).alias("amount_total"), as_numeric(F.sum("price_subtotal"), 12, 2).alias("amount_untaxed")
    )
    heads = orders.select(
        F.col("id").alias("order_id"), "partner_id", "company_id", "team_id", F.col("date_delivery").alias("__order_delivery")
    )
    rows = totals.join(receipts, RECEIPT).join(heads, "order_id")
    rows = default_currency(rows, companies)
    partners = orders.select(F.col("partner_id").alias("__partner")).distinct()
    partners = materialize(
        resolve_property(partners, properties, RECEIVABLE_PROPERTY, "res.partner", "__partner", "value", "account.account", out="account_id")
    )
    rows = rows.join(partners, F.col("partner_id").eqNullSafe(F.col("__partner")), "left").drop("__partner")
    rows = rows.withColumn("date_invoice", F.coalesce("delivery_date", "__order_delivery")).drop("delivery_date", "__order_delivery")
    rows = materialize(rows.withColumn("__block", id_block("receipt_id")))
    rows = number_documents(rows, ["receipt_id"], on_date=on_date, levels=["warehouse_id", "__block"], **counter)
    return rows.select(
        *RECEIPT,
        F.col("document_name").alias("number"),
        F.lit(None).cast("string").alias("origin"),
        "order_id",
        "partner_id",
        "company_id",
        "currency_id",
        "account_id",
        "user_id",
        "team_id",
        "receipt_ref",
        "date_invoice",
        "amount_total",
        "amount_untaxed",
        as_numeric(F.col("amount_total") - F.col("amount_untaxed"), 12, 2).alias("amount_tax"),
        F.col("amount_total").alias("residual"),
        F.lit("open").alias("state"),
        F.lit("out_invoice").alias("type"),
    )


def journal_entries(headers: DataFrame) -> DataFrame:
    """One posted entry per invoice, numbered like it."""
    return headers.select(
        *RECEIPT,
        F.col("number").alias("name"),
        posting_reference("number").alias("ref"),
        F.col("date_invoice").alias("date"),
        "company_id",
        "partner_id",
        "currency_id",
        F.lit("posted").alias("state"),
        F.col("origin").alias("narration"),
    )


def journal_lines(
    headers: DataFrame,
    inv_lines: DataFrame,
    tax_rows: DataFrame,
    accounts: DataFrame,
    journals: DataFrame,
    redemption: DataFrame | None = None,
) -> DataFrame:
    """Posting lines: sales and taxes on the credit side, redemption and receivable on the debit side.

    ``redemption`` (``warehouse_id, receipt_id, amount, account_id``) is empty unless given. Debits equal credits per
    entry.
    """
    zero = F.lit(0).cast("decimal(12,2)")
    shape = [*RECEIPT, "kind", "account_id", "name", "product_id", "product_uom", "quantity", "tax_line_id", "debit", "credit"]
    nothing = {"product_id": "bigint", "product_uom": "int", "tax_line_id": "int"}

    def line(df: DataFrame, kind: str, **cols) -> DataFrame:
        values = {"kind": F.lit(kind), "debit": zero, "credit": zero, "quantity": F.lit(1)}
        values |= {c: F.lit(None).cast(t) for c, t in nothing.items()} | cols
        return df.select(*[values.get(c, F.col(c)).alias(c) for c in shape])

    def amount(col) -> object:
        return as_numeric(col, 12, 2)

    sales = line(
        inv_lines,
        "sale",
        account_id=journal_account(journals, SALES_JOURNAL),
        name=posting_name("product_name"),
        product_id=F.col("product_id"),
        product_uom=F.col("product_uom"),
        quantity=F.col("quantity"),
        credit=amount("price_subtotal"),
    )
    taxes = line(
        tax_rows.filter(F.col("tax_amount") > 0),
        "tax",
        account_id=F.col("tax_account_id"),
        name=F.col("tax_name"),
        tax_line_id=F.col("tax_id"),
        credit=amount("tax_amount"),
    )
    net = F.col("residual")
    receivable_rows = headers
    rows = sales.unionByName(taxes)
    if redemption is not None:
        used = redemption.filter(F.col("amount") > 0)
        rows = rows.unionByName(
            line(used, "redemption", account_id=F.col("account_id"), name=F.lit("Redemption"), debit=amount("amount"))
        )
        receivable_rows = headers.join(used.select(*RECEIPT, F.col("amount").alias("__used")), RECEIPT, "left")
        net = net - F.coalesce("__used", F.lit(0))
    rows = rows.unionByName(
        line(receivable_rows.filter(net > 0), "receivable", account_id=F.col("account_id"), name=F.lit("/"), debit=amount(net))
    )
    rows = account_type(rows, accounts)
    return rows.withColumn("balance", as_numeric(F.col("debit") - F.col("credit"), 12, 2))


def tax_summary(tax_rows: DataFrame) -> DataFrame:
    """Tax summary rows of the invoices, keyed by receipt."""
    return tax_rows.filter(F.col("tax_amount") > 0).select(
        *LINE_KEY, "tax_id", F.col("tax_name").alias("name"), F.col("tax_account_id").alias("account_id"), F.col("tax_amount").alias("amount")
    )


def line_tax_relation(tax_rows: DataFrame) -> DataFrame:
    return tax_rows.select(*LINE_KEY, "tax_id")


def order_line_relation(inv_lines: DataFrame) -> DataFrame:
    return inv_lines.select(*LINE_KEY, F.col("order_line_id").alias("sale_order_line_id"))


def invoiced_changes(deliveries: DataFrame, headers: DataFrame) -> DataFrame:
    """Change set giving deliveries the number of their invoice."""
    numbers = headers.select(*RECEIPT, F.col("number").alias("invoice"))
    return deliveries.select("id", *RECEIPT).join(numbers, RECEIPT).select("id", "invoice")


def picking_changes(headers: DataFrame) -> DataFrame:
    """First-leg pickings that are now invoiced."""
    return headers.select(*RECEIPT, F.lit(1).alias("leg"), F.lit(True).alias("invoiced"))
