"""Columns of the business tables the operators read; stored tables may carry more."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

# Table and column names of the business data.
_DDL = {
    "stock_location": "id bigint, name string, complete_name string, usage string, parent_left bigint, parent_right bigint",
    "stock_warehouse": "id bigint, name string, parent_warehouse_id bigint, lot_stock_id bigint, "
    "wh_output_stock_loc_id bigint, wh_input_stock_loc_id bigint",
    "warehouse_product_rel": "warehouse_id bigint, product_id bigint",
    "ofc_locations": "id bigint, warehouse_id bigint, is_default boolean",
    "location_product_rel": "location_id bigint, product_id bigint",
    "stock_move": "id bigint, product_id bigint, company_id bigint, product_qty decimal(12,4), product_uom int, "
    "location_id bigint, location_dest_id bigint, state string, picking_id bigint, date date, price_unit decimal(12,2), "
    "remaining_qty decimal(18,6), remaining_value decimal(18,6), is_in boolean, is_out boolean",
    "product_uom": "id int, factor decimal(12,6)",
    "stock_picking": "id bigint, type string",
    "stock_picking_type": "id bigint, active boolean, warehouse_id bigint, code string, default_location_src_id bigint, "
    "default_location_dest_id bigint",
    "stock_quant": "id bigint, product_id bigint, location_id bigint, quantity decimal(12,2), unit_cost decimal(12,4), "
    "in_date date",
    "stock_warehouse_orderpoint": "id bigint, warehouse_id bigint, location_id bigint, company_id bigint, "
    "product_id bigint, active boolean, product_min_qty decimal(12,4), product_max_qty decimal(12,4), "
    "qty_multiple decimal(12,4)",
    "stock_exceptions": "warehouse_id bigint, product_id bigint, sync_date date, state string, initial_qoh int, "
    "kitted_qty bigint, adjusted_qty int",
    "product_product": "id bigint, product_tmpl_id bigint, default_code string, name string, weight decimal(12,4), "
    "active boolean, valuation string",
    "product_template": "id bigint, name string, default_code string, size string, categ_id bigint, uom_po_id int, "
    "commissiontier_id bigint, sale_ok boolean",
    "product_category": "id bigint, parent_id bigint, name string",
    "sale_order": "id bigint, name string, partner_id bigint, customer_id bigint, company_id bigint, date_order date, "
    "date_delivery date, state string, is_duplicate boolean, islayaway boolean, requisitioned boolean, "
    "confirmation_date date, user_id bigint, team_id bigint, note string",
    "sale_order_line": "id bigint, order_id bigint, product_id bigint, product_uom int, product_uom_qty int, "
    "price_unit decimal(12,2), state string, name string, company_id bigint, ofc_id bigint, default_ofc_id bigint, "
    "ofc_location_id bigint, commission decimal(12,2), order_partner_id bigint",
    "sale_order_tax": "order_line_id bigint, tax_id int",
    "res_partner": "id bigint, agent_type_id int, route_id int, warehouse_id bigint",
    "res_company": "id bigint, currency_id bigint",
    "account_voucher": "order_id bigint, amount decimal(12,4), state string",
    "account_invoice_line": "id bigint, order_line_id bigint, quantity decimal(12,2)",
    "account_tax": "id int, name string, amount decimal(12,6), amount_type string, price_include boolean, "
    "include_base_amount boolean, account_id bigint, active boolean",
    "product_taxes_rel": "prod_id bigint, tax_id int",
    "account_account": "id bigint, user_type_id int",
    "account_journal": "id bigint, code string, default_debit_account_id bigint",
    "ir_property": "name string, res_id string, value_reference string, value_text string, value_integer int, "
    "value_float double, value_datetime timestamp_ntz",
    "ofs_delivery": "id bigint, warehouse_id bigint, receipt_id bigint, line_id bigint, qty int, processed boolean, "
    "remarks string, order_id bigint, user_id bigint, receipt_ref string, date_delivery date, date date",
    "ofs_cancel_order": "id bigint, order_id bigint, ofc_id bigint, user_id bigint, line_id bigint, cancelled_qty int, "
    "processed boolean",
    "receipt_document": "warehouse_id bigint, receipt_id bigint, state string",
    "receipt_invoice": "warehouse_id bigint, receipt_id bigint, state string",
    "wkf_instance": "id bigint, res_id bigint, res_type string, state string",
}

TABLES = tuple(_DDL)


@cache
def schema(name: str) -> StructType:
    """Declared schema of a table (parsed by the running session)."""
    return StructType.fromDDL(_DDL[name])
