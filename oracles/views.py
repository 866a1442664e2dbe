"""The business tables as SQL over the star-schema tables; inlined into a statement as common table expressions."""

from __future__ import annotations

import re

_STEP_N, _STEP_R = 2**32, 2**38

VIEWS = {
    "loc": f"""
        select 1::bigint as id, 'ALL' as name, '-1/-1/ALL' as complete_name, 'view' as usage, 0::bigint as l, {30 * _STEP_R - 1}::bigint as r
        union all select 10 + r_regionkey, r_name, r_regionkey || '/-1/' || r_name, 'view',
          (r_regionkey + 1)::bigint * {_STEP_R}, (r_regionkey + 2)::bigint * {_STEP_R} - 1 from region
        union all select 100 + n_nationkey, n_name, n_regionkey || '/' || n_nationkey || '/' || n_name, 'view',
          (n_regionkey + 1)::bigint * {_STEP_R} + (n_nationkey + 1)::bigint * {_STEP_N},
          (n_regionkey + 1)::bigint * {_STEP_R} + (n_nationkey + 2)::bigint * {_STEP_N} - 1 from nation
        union all select b + s_suppkey, s_name || t, n_regionkey || '/' || n_nationkey || '/' || s_name || t, 'internal',
          (n_regionkey + 1)::bigint * {_STEP_R} + (n_nationkey + 1)::bigint * {_STEP_N} + (s_suppkey + 1) * 2 + k,
          (n_regionkey + 1)::bigint * {_STEP_R} + (n_nationkey + 1)::bigint * {_STEP_N} + (s_suppkey + 1) * 2 + k
          from supplier join nation on n_nationkey = s_nationkey, (values (1000, '/Stock', 0), (5000000000, '/Output', 1)) v(b, t, k)
        union all select i, t, '30/' || i || '/' || t, u, 31 * {_STEP_R} + (i + 1) * {_STEP_N} + 2, 31 * {_STEP_R} + (i + 1) * {_STEP_N} + 2
          from (values (2, 'Customers', 'customer'), (3, 'Vendors', 'supplier'), (4, 'Inventory loss', 'inventory'), (5, 'Scrapped', 'inventory')) v(i, t, u)""",
    "wh": """
        select s_suppkey as id, s_name as name, case when s_suppkey % 4 <> 0 then s_suppkey - s_suppkey % 4 end as parent_id,
          1000 + s_suppkey as stock_id, 5000000000 + s_suppkey as output_id, 1000 + s_suppkey as input_id from supplier""",
    "ofc_loc": """
        select s_suppkey * 10 + k as id, s_suppkey as warehouse_id, k = 0 and s_suppkey % 10 <> 9 as is_default
        from supplier, (values (0), (1), (2)) v(k)""",
    "loc_prod": "select distinct l_suppkey * 10 + 1 + l_partkey % 2 as location_id, l_partkey as product_id from lineitem where l_linenumber <= 2",
    "wh_prod": "select distinct l_suppkey as warehouse_id, l_partkey as product_id from lineitem where l_linenumber <= 2",
    "ptype": """
        select s_suppkey * 10 + k as id, k <> 0 or s_suppkey % 6 <> 0 as active, s_suppkey as warehouse_id,
          case k when 2 then 'incoming' else 'outgoing' end as code,
          case k when 1 then 1000 + s_suppkey when 2 then 3 end as src, case k when 1 then 2 end as dest
        from supplier, (values (0), (1), (2)) v(k)""",
    "uom": "select * from (values (1, 1.0::decimal(12,6)), (2, 0.5::decimal(12,6)), (3, 0.25::decimal(12,6))) v(id, factor)",
    "prod": """
        select p_partkey as id, p_partkey + 7 as tmpl_id, case when p_partkey % 50 <> 0 then 'P' || (p_partkey - p_partkey % 2) end as code,
          p_name as name, (p_size * 25)::decimal(12,2) as w100, p_partkey % 17 <> 0 as active, p_partkey % 3 <> 0 as real_time from part""",
    "tmpl": """
        select p_partkey + 7 as id, p_name as name, case when p_partkey % 50 <> 0 then 'T' || p_partkey end as code,
          case when p_type = 'LARGE' then 'big' else 'std' end as size, substr(p_brand, 7)::bigint as categ_id,
          (p_partkey % 3 + 1)::int as uom_po_id, p_partkey % 4 as tier_id, p_partkey % 13 <> 0 as sale_ok from part""",
    "cat": """
        select substr(p_brand, 7)::bigint as id, p_brand as name,
          case substr(p_brand, 7)::bigint when 1 then 354 when 2 then 352 when 3 then 365 when 4 then 365 else 100 end as parent_id
        from part group by p_brand""",
    "opoint": """
        select p_partkey * 10 + w as id, w as warehouse_id, 1000 + w as location_id, 1 + p_partkey % 2 as company_id, p_partkey as product_id,
          p_partkey % 7 <> 0 as active, 5 as min_qty, 20 + p_size as max_qty, 1 + p_size % 4 as multiple
        from part, range(10) t(w) where p_partkey % 3 = 0""",
    "partner": """
        select c_custkey as id, (c_custkey % 3)::int as agent_type_id, (c_custkey % 17)::int as route_id,
          case when c_custkey % 8 <> 5 then (c_custkey * 7) % 10 end as warehouse_id from customer""",
    "company": "select r_regionkey + 1 as id, (100 + r_regionkey)::bigint as currency_id from region",
    "account": "select 690 + n_nationkey as id, n_nationkey % 4 + 1 as user_type_id from nation",
    "tax": """
        select * from (values (1, 'Std', 0.16::decimal(12,6), 'percent', true, 701::bigint), (2, 'Low', 0.08::decimal(12,6), 'percent', true, 702),
          (3, 'Levy', 5::decimal(12,6), 'fixed', true, 703), (4, 'Old', 0.2::decimal(12,6), 'percent', false, 704))
          v(id, name, rate, kind, active, account_id)""",
    "tmpl_tax": """
        select p_partkey + 7 as tmpl_id, (1 + p_partkey % 4)::int as tax_id from part where p_partkey % 5 <> 0
        union all select p_partkey + 7, 2 from part where p_partkey % 7 = 0 and p_partkey % 4 <> 1""",
    "prop": """
        select 'property_account_receivable_id' as name, 'res.partner,' || c_custkey as res_id,
          case when c_custkey % 6 = 0 then '' else 'account.account,' || (700 + c_custkey % 9) end as ref,
          null::varchar as txt, null::int as num, null::double as flt, null::timestamp as dt from customer where c_custkey % 3 = 0
        union all select 'property_account_receivable_id', null, 'account.account,699', null, null, null, null
        union all select 'property_limit', 'res.partner,' || c_custkey, null, case when c_custkey % 6 <> 0 then 'text ' || c_custkey else '' end,
          case when c_custkey % 9 <> 0 then c_custkey % 100 end, case when c_custkey % 9 <> 0 then (c_custkey % 100) / 4.0::double end,
          case when c_custkey % 9 <> 0 then (date '2020-01-01' + (c_custkey % 300)::int)::timestamp end from customer where c_custkey % 3 = 0
        union all select 'property_limit', null, null, '42', null, null, null""",
    "so": """
        select o_orderkey as id, 'SO' || o_orderkey as name, o_custkey % 40 as partner_id, o_custkey as customer_id, 1 + o_orderkey % 2 as company_id,
          o_orderdate::date as date_order, o_orderdate::date + (o_orderkey % 9)::int as date_delivery,
          case o_orderstatus when 'P' then 'draft' when 'O' then 'progress' else 'done' end as state,
          case when o_orderkey % 43 <> 0 then o_orderkey % 41 = 0 end as is_duplicate, o_orderkey % 29 = 0 as islayaway,
          o_orderkey % 5 = 0 as requisitioned, case when o_orderstatus <> 'P' then make_date(year(o_orderdate), 12, 31) end as confirmation_date,
          o_orderkey % 6 as user_id, o_orderkey % 4 as team_id from orders""",
    "ln": """
        select l_orderkey * 1000 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as id,
          l_orderkey as order_id, l_partkey as product_id, l_suppkey as home, l_linenumber as number, l_returnflag as flag, l_linestatus as status,
          l_shipdate::date as ship_date, (1 + floor(l_quantity)::int % 3)::int as qty from lineitem""",
    "sol": """
        select ln.id, order_id, product_id, (1 + product_id % 3)::int as uom_id, qty,
          (p_retailprice::decimal(12,2) * (1 + home % 2 + case when number = 7 then 6 else 0 end))::decimal(12,2) as price_unit,
          case when flag = 'R' and status = 'O' then 'cancel' else 'confirmed' end as state, 'Line ' || ln.id as name,
          case when order_id % 101 <> 0 then 1 + order_id % 2 end as company_id, home as ofc_id,
          case when home % 4 <> 0 then home - home % 4 end as default_ofc_id, case when product_id % 4 <> 0 then home * 10 end as ofc_location_id,
          (qty * 1.5)::decimal(12,2) as commission, order_id % 40 as order_partner_id
        from ln join part on p_partkey = product_id""",
    "sol_tax": "select id as order_line_id, 1 as tax_id from ln where id % 3 = 0 union all select id, 2 from ln where id % 6 = 0",
    "voucher": """
        select o_orderkey as order_id, 2000 + (o_orderkey % 11) * 1500 as amount, case when o_orderkey % 4 = 0 then 'draft' else 'booked' end as state
        from orders where o_orderkey % 3 = 0""",
    "inv_ln": "select id * 2 as id, id as order_line_id, qty - case when number = 4 then 1 else 0 end as quantity from ln where flag <> 'A'",
    "wkf": """
        select o_orderkey * 3 as id, o_orderkey as res_id, case when o_orderkey % 10 = 0 then 'stock.picking' else 'sale.order' end as res_type,
          case when o_orderkey % 7 = 0 then 'active' else 'complete' end as state from orders""",
    "picking": "select o_orderkey as id, case when o_orderkey % 3 = 0 then 'out' else 'in' end as type from orders",
    "mv": """
        select ln.id, product_id, 1 as company_id, qty, (1 + product_id % 3)::int as uom_id, order_id as picking_id, ship_date as date,
          (p_retailprice::decimal(12,2) * (1 + home % 2 + case when number = 7 then 6 else 0 end))::decimal(12,2) as price_unit,
          case when order_id % 97 = 0 then null when flag = 'A' then 3 else 1000 + home end as src,
          case flag when 'A' then 1000 + home when 'N' then 2 else 1000 + home - home % 4 end as dest,
          case when status = 'F' then 'done' when number % 3 = 0 then 'assigned' when number % 3 = 1 then 'confirmed' else 'cancel' end as state,
          case when flag = 'A' then qty when flag = 'N' and number % 2 = 0 then -qty else 0 end as rem, flag = 'A' as is_in, flag = 'N' as is_out
        from ln join part on p_partkey = product_id""",
    "quant": """
        select ln.id, product_id, 1000 + home as location_id, case flag when 'A' then qty when 'N' then -qty else 0 end as quantity,
          (p_retailprice::decimal(12,2) * (1 + home % 2 + case when number = 7 then 6 else 0 end))::decimal(12,4) as unit_cost, ship_date as in_date
        from ln join part on p_partkey = product_id""",
    "exc": """
        select distinct l_suppkey as warehouse_id, l_partkey as product_id,
          case when l_partkey % 3 = 0 then date '2001-07-29' else date '2001-07-30' end as sync_date,
          case when l_partkey % 5 = 0 then 'done' else 'new' end as state, 10 as initial_qoh, 5 as kitted_qty, 1 as adjusted_qty
        from lineitem where l_returnflag = 'N' and l_linenumber = 1""",
    "dlv": """
        select id * 10 + c as id, home as warehouse_id, order_id as receipt_id, case when id % 89 <> 0 then id end as line_id, qty, id % 7 = 0 as processed,
          order_id, case when order_id % 13 <> 0 then order_id % 6 end as user_id, 'R' || order_id as receipt_ref,
          case when order_id % 3 = 0 then ship_date end as date_delivery, case when order_id % 6 <> 1 then ship_date + 1 end as date
        from ln, (values (0), (1)) v(c) where flag = 'N' and (c = 0 or product_id % 10 = 0)""",
    "creq": """
        select id, order_id, case when number = 5 then home + 1 else home end as ofc_id, product_id % 6 as user_id,
          case when number <> 6 then id end as line_id, 1 + product_id % 3 as cancelled_qty from ln where flag = 'A' and product_id % 4 = 0""",
    "doc": """
        select distinct l_suppkey as warehouse_id, l_orderkey as receipt_id, case when l_orderkey % 46 = 0 then 'cancel' else 'done' end as state
        from lineitem where l_returnflag = 'N' and l_orderkey % 23 = 0""",
    "idoc": """
        select distinct l_suppkey as warehouse_id, l_orderkey as receipt_id, case when l_orderkey % 62 = 0 then 'cancel' else 'open' end as state
        from lineitem where l_returnflag = 'N' and l_orderkey % 31 = 0""",
}


def _needs(text: str, parts: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [name for name in parts if name in words]


def statement(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the views, and the named extra expressions, it refers to."""
    parts = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _needs(parts[name], parts):
            if other != name:
                visit(other)
        order.append(name)

    for name in _needs(query, parts):
        visit(name)
    ctes = ",\n".join(f"{name} as ({parts[name].strip()})" for name in order)
    return f"with {ctes}\n{query.strip()}" if ctes else query.strip()
