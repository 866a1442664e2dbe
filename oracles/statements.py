"""One SQL statement per registered query. Written from the rules, not from the Spark code."""

from __future__ import annotations

import re

from oracles.views import VIEWS, statement

RUN, CONFIRMED, DEMAND = "date '2001-07-30'", "date '1997-12-31'", "date '2000-06-15'"

PARTS = {
    # Subtrees by interval containment.
    "tree": "select p.id as a, n.id as d, n.name, n.complete_name from loc p join loc n on n.l between p.l and p.r",
    "stock_tree": "select a, d from tree where a in (select stock_id from wh)",
    # Stock flows per subtree, done or pending.
    "flow_in": """
        select t.a, m.product_id, m.uom_id, m.state, m.picking_id, sum(m.qty / u.factor) as q from mv m join uom u on u.id = m.uom_id
        join tree t on t.d = m.dest where m.src is not null and not exists (select 1 from tree x where x.a = t.a and x.d = m.src)
        group by all""",
    "flow_out": """
        select t.a, m.product_id, m.uom_id, m.state, m.picking_id, sum(m.qty / u.factor) as q from mv m join uom u on u.id = m.uom_id
        join tree t on t.d = m.src where m.dest is not null and not exists (select 1 from tree x where x.a = t.a and x.d = m.dest)
        group by all""",
    "on_hand_tree": """
        select coalesce(i.a, o.a) as a, coalesce(i.product_id, o.product_id) as product_id,
          (case when i.q is null then 0 else i.q - coalesce(o.q, 0) end)::decimal(12,2) as qty
        from (select a, product_id, sum(q) as q from flow_in where state = 'done' group by all) i
        full join (select a, product_id, sum(q) as q from flow_out where state = 'done' group by all) o
          on i.a = o.a and i.product_id = o.product_id""",
    "on_hand": "select a, product_id, qty from on_hand_tree where a in (select stock_id from wh)",
    "incoming": """
        select coalesce(i.a, o.a) as a, coalesce(i.product_id, o.product_id) as product_id,
          (case when i.q is null then 0 else i.q - coalesce(o.q, 0) end)::decimal(12,2) as qty
        from (select a, product_id, sum(q) as q from flow_in where state in ('assigned', 'confirmed') and picking_id in (select id from picking where type = 'in') group by all) i
        full join (select a, product_id, sum(q) as q from flow_out where state in ('assigned', 'confirmed') and picking_id in (select id from picking where type = 'in') group by all) o
          on i.a = o.a and i.product_id = o.product_id
        where coalesce(i.a, o.a) in (select stock_id from wh)""",
    "open_demand": f"""
        select p.id as warehouse_id, l.product_id, sum(l.qty)::decimal(12,2) as qty from so o join sol l on l.order_id = o.id
        join partner p on p.id = o.partner_id where o.state in ('draft', 'progress') and o.date_delivery > {DEMAND} and o.date_order <= {DEMAND} group by all""",
    "avail": """
        select coalesce(h.w, d.warehouse_id) as warehouse_id, coalesce(h.product_id, d.product_id) as product_id,
          (coalesce(h.qty, 0) - coalesce(d.qty, 0))::decimal(12,2) as qty
        from (select wh.id as w, product_id, qty from on_hand join wh on wh.stock_id = a) h
        full join open_demand d on d.warehouse_id = h.w and d.product_id = h.product_id""",
    "held": "select distinct f.warehouse_id, r.product_id from loc_prod r join ofc_loc f on f.id = r.location_id",
    "assigned": "select f.warehouse_id, r.product_id, min(f.id) as place from loc_prod r join ofc_loc f on f.id = r.location_id group by all",
    "deflt": "select warehouse_id, min(id) as place from ofc_loc where is_default group by all",
    # Confirmation.
    "cand": f"""
        select * from so where state = 'draft' and date_order <= {RUN} and confirmation_date is null and (is_duplicate is null or not is_duplicate)""",
    "known_ln": "select l.*, t.size, t.categ_id, p.w100 from sol l join prod p on p.id = l.product_id join tmpl t on t.id = p.tmpl_id",
    "hv": """
        select order_id, coalesce(sum(case when c.parent_id = 365 then null else price_unit * qty end), 0)::decimal(14,2) as amount,
          coalesce(bool_or(c.parent_id <> 365 and price_unit >= 6000), false) as dear from known_ln k left join cat c on c.id = k.categ_id group by order_id""",
    "disp0": """
        select c.id as order_id, c.date_order, c.date_delivery, c.islayaway, hv.amount, hv.dear or hv.amount >= 10000 as high,
          (case when hv.dear or hv.amount >= 10000 or c.islayaway then coalesce((select sum(v.amount) from voucher v where v.order_id = c.id and v.state = 'booked'), 0) else 0 end)::decimal(14,2) as paid
        from cand c left join hv on hv.order_id = c.id""",
    "disp": """
        select *, case when amount is null then 'cancel_empty'
          when islayaway and paid >= amount then 'confirm' when not islayaway and (not high or paid >= floor(amount * 50) / 100) then 'confirm'
          when not islayaway and date_order < date '2001-07-27' then 'cancel_unpaid' else 'hold' end as disposition from disp0""",
    "ord_chg": f"""
        select order_id as id, case disposition when 'confirm' then 'progress' else 'cancel' end as state,
          case disposition when 'cancel_unpaid' then 'High Value Order Cancelled by Order Confirmation Process' end as note,
          case disposition when 'confirm' then {RUN} end as confirmation_date,
          case when disposition = 'confirm' and paid > 0 and date_order < {RUN} then
            case (date_delivery - date_order) when 7 then date '2001-08-06' when 6 then date '2001-08-04' when 5 then date '2001-08-03' when 4 then date '2001-08-02'
              when 3 then date '2001-08-01' when 2 then date '2001-07-31' else {RUN} end end as date_delivery
        from disp where disposition <> 'hold'""",
    # Requisition.
    "req_so": f"""
        select o.*, case when o.partner_id = 0 then 1 else p.warehouse_id end as warehouse_id from so o left join partner p on p.id = o.partner_id
        where o.confirmation_date = {CONFIRMED} and o.is_duplicate = false and o.requisitioned = false and o.state not in ('draft', 'cancel', 'rejected')""",
    "stg": """
        select l.id, l.order_id, o.name as order_name, l.product_id, l.company_id, t.uom_po_id, u.factor, l.qty,
          case when w.parent_id is null or h.product_id is not null then o.warehouse_id else w.parent_id end as ofc
        from sol l join req_so o on o.id = l.order_id join prod p on p.id = l.product_id join tmpl t on t.id = p.tmpl_id join uom u on u.id = t.uom_po_id
        left join wh w on w.id = o.warehouse_id left join held h on h.warehouse_id = o.warehouse_id and h.product_id = l.product_id""",
    "dem": """
        select product_id, company_id, uom_po_id, ofc, factor, sum(qty * factor)::decimal(12,4) as po_qty, sum(qty)::decimal(12,4) as qty from stg group by all""",
    "waiting": f"""
        select l.product_id, sum(l.qty)::int as qty from sol l join so o on o.id = l.order_id
        where o.state = 'progress' and o.date_delivery > {CONFIRMED} and o.date_order < {CONFIRMED} and o.confirmation_date < {RUN} group by all""",
    "net0": """
        select d.*, w.stock_id, round(coalesce(h.qty, 0))::int as onhand, (coalesce(i.qty, 0) * factor)::decimal(12,4) as p_in, (coalesce(p.qty, 0) * factor)::decimal(12,4) as p_out
        from dem d left join wh w on w.id = d.ofc left join on_hand h on h.a = w.stock_id and h.product_id = d.product_id
        left join incoming i on i.a = w.stock_id and i.product_id = d.product_id left join waiting p on p.product_id = d.product_id""",
    "net": """
        select *, (onhand * factor)::decimal(18,2)::int as po_onhand, (po_qty - ((onhand * factor)::decimal(18,2)::int - p_out))::decimal(18,4) as gap from net0""",
    "ropt": """
        select n.*, coalesce(p.min_qty, 0)::decimal(12,4) as min_qty, coalesce(p.max_qty, 0)::decimal(12,4) as max_qty, coalesce(p.multiple, 1) as multiple,
          (n.onhand - n.p_out)::decimal(12,4) as projected
        from net n left join opoint p on p.active and p.warehouse_id = n.ofc and p.location_id = n.stock_id and p.company_id = n.company_id and p.product_id = n.product_id""",
    "rhead": """
        select 99 + row_number() over (order by ofc nulls last, company_id nulls last) as no, ofc, company_id from (select distinct ofc, company_id from dem)""",
    # Intake and cancellation.
    "dup": """
        select *, not processed and line_id is not null and qty is not null and id > min(id) filter (not processed) over (partition by warehouse_id, receipt_id, line_id, qty) as is_dup from dlv""",
    "cr": """
        select c.*, case when c.line_id is null then null when l.id is null then 0 else l.qty end as ordered,
          coalesce(l.order_id = c.order_id and l.ofc_id = c.ofc_id, false) as here, l.commission, l.product_id
        from creq c left join sol l on l.id = c.line_id""",
    "can_ln": """
        select l.*, coalesce(x.cut, 0) as cut, case when x.whole is not null or a.whole is not null then greatest(coalesce(x.whole, 0), coalesce(a.whole, 0)) end as by_request
        from sol l left join (select line_id, sum(cancelled_qty) filter (cancelled_qty < ordered) as cut, max(id) filter (not cancelled_qty < ordered and here) as whole from cr where line_id is not null group by all) x on x.line_id = l.id
        left join (select order_id, ofc_id, max(id) as whole from cr where line_id is null group by all) a on a.order_id = l.order_id and a.ofc_id = l.ofc_id""",
    # Kitting.
    "fresh": """
        select d.* exclude (is_dup, processed), d.processed or d.is_dup as processed from dup d
        where not exists (select 1 from doc where doc.warehouse_id = d.warehouse_id and doc.receipt_id = d.receipt_id and doc.state <> 'cancel')""",
    "kit": f"""
        select f.id as delivery_id, f.warehouse_id, f.receipt_id, l.id as line, l.order_id, o.name as order_name, o.partner_id, o.company_id, l.product_id, l.name as product_name,
          l.uom_id, l.qty as ordered_qty, f.qty, (f.qty * p.w100 / 100)::decimal(12,4) as weight, coalesce(l.default_ofc_id, f.warehouse_id) as agent, f.receipt_ref, o.date_delivery
        from fresh f join sol l on l.id = f.line_id join so o on o.id = l.order_id join prod p on p.id = l.product_id
        where not f.processed and o.state not in ('draft', 'cancel')""",
    "rtot": """
        select warehouse_id, receipt_id, sum(weight)::decimal(18,4) as weight, count(*) as items, arg_max(order_id, line) as order_id, arg_max(order_name, line) as order_name,
          arg_max(partner_id, line) as partner_id, arg_max(company_id, line) as company_id, arg_max(receipt_ref, line) as receipt_ref, arg_max(agent, line) as agent from kit group by all""",
    "need": """
        select k.warehouse_id, k.product_id, k.delivery_id, k.line, sum(k.qty) over w - k.qty as lo, sum(k.qty) over w as hi from kit k
        window w as (partition by k.warehouse_id, k.product_id order by k.delivery_id)""",
    "have": """
        select w.id as warehouse_id, q.product_id, q.id, q.unit_cost, sum(q.quantity) over s - q.quantity as lo, sum(q.quantity) over s as hi
        from quant q join wh w on w.stock_id = q.location_id where q.quantity > 0 window s as (partition by w.id, q.product_id order by q.in_date, q.id)""",
    "used": """
        select n.delivery_id, n.line, h.id as quant_id, least(n.hi, h.hi) - greatest(n.lo, h.lo) as q, h.unit_cost from need n join have h
        on h.warehouse_id = n.warehouse_id and h.product_id = n.product_id and h.lo < n.hi and n.lo < h.hi
        union all select n.delivery_id, n.line, null, -(n.hi - greatest(n.lo, coalesce(t.total, 0))), null from need n
        left join (select warehouse_id, product_id, max(hi) as total from have group by all) t on t.warehouse_id = n.warehouse_id and t.product_id = n.product_id
        where n.hi > coalesce(t.total, 0)""",
    "lcost": """
        select line, sum(q)::int as qty, sum((q * unit_cost)::decimal(12,4))::decimal(18,4) as total, (sum((q * unit_cost)::decimal(12,4)) / sum(q))::decimal(12,4) as cost
        from used where q > 0 group by line""",
    "route": """
        select w.id, w.stock_id, w.output_id, (select min(t.id) from ptype t where t.active and t.warehouse_id = w.id and t.code = 'outgoing'
          and coalesce(t.src, w.stock_id) = w.stock_id and coalesce(t.dest, 2) = 2) as ptype_id from wh w""",
    "legs": """
        select r.*, g.leg, case g.leg when 1 then own.stock_id when 2 then own.output_id else ag.output_id end as src, case g.leg when 1 then own.output_id when 2 then ag.output_id else (select min(id) from loc where usage = 'customer') end as dest,
          case g.leg when 3 then 'assigned' else 'done' end as state, own.ptype_id
        from rtot r join route own on own.id = r.warehouse_id left join route ag on ag.id = r.agent cross join (values (1), (2), (3)) g(leg)
        where g.leg <> 2 or r.agent <> r.warehouse_id""",
    "thead": """
        select *, row_number() over (partition by leg = 3 order by warehouse_id, receipt_id, leg) as no from legs where partner_id in (select id from partner)""",
    "tmove": """
        select g.warehouse_id, g.receipt_id, k.delivery_id, g.leg, k.line, k.product_id, k.uom_id, k.qty, k.ordered_qty, k.company_id, k.partner_id, g.ptype_id, g.src, g.dest, g.state, k.order_name, k.weight
        from kit k join legs g on g.warehouse_id = k.warehouse_id and g.receipt_id = k.receipt_id where k.partner_id in (select id from partner)""",
    # Invoicing.
    "rord": """
        select warehouse_id, receipt_id, arg_min(order_id, id) as order_id, min_by({'u': user_id, 'd': coalesce(date_delivery, date), 'r': receipt_ref}, id) as x from fresh group by all""",
    "bill": """
        select m.warehouse_id, m.receipt_id, m.line, l.order_id, m.product_id, l.name, l.uom_id, l.price_unit::decimal(10,2) as price_unit, sum(m.qty)::int as quantity, m.product_id + 7 as tmpl_id
        from tmove m join rord r on r.warehouse_id = m.warehouse_id and r.receipt_id = m.receipt_id join sol l on l.id = m.line and l.order_id = r.order_id where m.leg = 1
          and not exists (select 1 from idoc i where i.warehouse_id = m.warehouse_id and i.receipt_id = m.receipt_id and i.state <> 'cancel') group by all having sum(m.qty) <> 0""",
    "trate": "select z.tmpl_id, sum(y.rate) as total_rate from tmpl_tax z join tax y on y.id = z.tax_id and y.active group by all",
    "btax": """
        select b.warehouse_id, b.receipt_id, b.line, b.product_id, b.order_id, x.tax_id, t.name as tax_name, t.account_id, r.total_rate,
          (case t.kind when 'percent' then b.price_unit * b.quantity / (1 + r.total_rate) * t.rate when 'fixed' then t.rate * b.quantity end)::decimal(12,2) as amount
        from bill b join tmpl_tax x on x.tmpl_id = b.tmpl_id left join trate r on r.tmpl_id = b.tmpl_id left join tax t on t.id = x.tax_id and t.active""",
    "bline": """
        select b.*, coalesce((select sum(amount) from btax t where t.warehouse_id = b.warehouse_id and t.receipt_id = b.receipt_id and t.line = b.line), 0)::decimal(10,2) as tax_sum,
          (price_unit * quantity)::decimal(12,2) as gross from bill b""",
    "bhead": """
        select b.warehouse_id, b.receipt_id, b.total, b.untaxed, row_number() over (order by b.warehouse_id, b.receipt_id) as no, 'INV/2001/' || row_number() over (order by b.warehouse_id, b.receipt_id) as number,
          o.id as order_id, o.partner_id, o.company_id, c.currency_id, coalesce(nullif(replace(p.ref, 'account.account,', ''), ''), '699')::int as account_id, r.x.u as user_id, o.team_id, r.x.r as receipt_ref, coalesce(r.x.d, o.date_delivery) as date_invoice
        from (select warehouse_id, receipt_id, sum(gross)::decimal(12,2) as total, sum(gross - tax_sum)::decimal(12,2) as untaxed from bline group by all) b
        join rord r on r.warehouse_id = b.warehouse_id and r.receipt_id = b.receipt_id join so o on o.id = r.order_id left join company c on c.id = o.company_id
        left join prop p on p.name = 'property_account_receivable_id' and p.res_id = 'res.partner,' || o.partner_id""",
    "jline": """
        select warehouse_id, receipt_id, 'sale' as kind, 690::bigint as account_id, left(name, 64) as name, product_id, uom_id, quantity, null::int as tax_line_id, 0::decimal(12,2) as debit, (gross - tax_sum)::decimal(12,2) as credit from bline
        union all select warehouse_id, receipt_id, 'tax', account_id, tax_name, null, null, 1, tax_id, 0, amount from btax where amount > 0
        union all select warehouse_id, receipt_id, 'receivable', account_id, '/', null, null, 1, null, total, 0 from bhead where total > 0""",
    # Reports.
    "bal": """
        select q.product_id, p.code_name, q.location_id, l.complete_name, sum(q.quantity) as qty from quant q join loc l on l.id = q.location_id and l.usage = 'internal'
        join (select prod.id, prod.code || ' - ' || tmpl.name as code_name from prod join tmpl on tmpl.id = prod.tmpl_id) p on p.id = q.product_id group by all having sum(q.quantity) <> 0""",
    # Stock as each receipt finds it: moves before the run, and the done legs of receipts before it.
    "feed": """
        select t.a, m.product_id, m.warehouse_id, m.receipt_id, sum(m.qty / u.factor) as q_in, null as q_out from tmove m join uom u on u.id = m.uom_id
        join stock_tree t on t.d = m.dest where m.state = 'done' and m.src is not null and not exists (select 1 from stock_tree x where x.a = t.a and x.d = m.src) group by all
        union all
        select t.a, m.product_id, m.warehouse_id, m.receipt_id, null, sum(m.qty / u.factor) from tmove m join uom u on u.id = m.uom_id
        join stock_tree t on t.d = m.src where m.state = 'done' and m.dest is not null and not exists (select 1 from stock_tree x where x.a = t.a and x.d = m.dest) group by all""",
    "turn": """
        select c.warehouse_id, c.receipt_id, c.product_id, c.a, sum(f.q_in) as q_in, sum(f.q_out) as q_out
        from (select distinct k.warehouse_id, k.receipt_id, k.product_id, w.stock_id as a from kit k join wh w on w.id = k.warehouse_id) c
        left join feed f on f.a = c.a and f.product_id = c.product_id and (f.warehouse_id < c.warehouse_id or f.warehouse_id = c.warehouse_id and f.receipt_id < c.receipt_id)
        group by all""",
    "kqoh": """
        select t.warehouse_id, t.receipt_id, t.product_id, round((case when i.q is null and t.q_in is null then 0
          else coalesce(i.q, 0) + coalesce(t.q_in, 0) - coalesce(o.q, 0) - coalesce(t.q_out, 0) end)::decimal(12,2))::int as qoh
        from turn t left join (select a, product_id, sum(q) as q from flow_in where state = 'done' group by all) i on i.a = t.a and i.product_id = t.product_id
        left join (select a, product_id, sum(q) as q from flow_out where state = 'done' group by all) o on o.a = t.a and o.product_id = t.product_id""",
    # Exceptions receipt by receipt: what is open already adds up, else the short lines of a receipt open a row.
    "krec": """
        select k.warehouse_id, k.product_id, k.receipt_id, max(h.qoh) as qoh, sum(k.qty) as q, sum(k.qty) filter (k.qty - h.qoh > 0) as short
        from kit k join kqoh h on h.warehouse_id = k.warehouse_id and h.receipt_id = k.receipt_id and h.product_id = k.product_id group by all""",
    "kopen": f"""
        select r.*, exists (select 1 from exc e where e.warehouse_id = r.warehouse_id and e.product_id = r.product_id and e.state = 'new' and e.sync_date = {RUN}) as known,
          coalesce(bool_or(short is not null) over (partition by warehouse_id, product_id order by receipt_id rows between unbounded preceding and 1 preceding), false) as opened
        from krec r""",
    "kq": """
        select warehouse_id, product_id, known, sum(case when known or opened then q else short end) as q, min(case when not opened and short is not null then qoh end) as qoh
        from kopen group by all""",
    # FIFO repair by range joins.
    "fm": "select * from mv where ((is_in or is_out) and rem < 0) or (is_in and rem > 0)",
    "fnet": """
        select *, sum(-rem) over (partition by product_id order by date, id) as net, coalesce(sum(case when rem < 0 then -rem end) over (partition by product_id order by date, id), 0) as asked from fm""",
    "fback": "select *, net - least(0, min(net) over (partition by product_id order by date, id)) as backlog from fnet",
    "fserved": "select *, asked - backlog as served from fback",
    "takers": "select product_id, id, asked + rem as lo, asked as hi from fserved where rem < 0",
    "givers": """
        select product_id, id, price_unit, coalesce(lag(served) over (partition by product_id order by date, id), 0) as lo, served as hi from fserved where rem > 0 or rem < 0""",
    "alloc": """
        select t.product_id, t.id as taker_id, g.id as giver_id, least(t.hi, g.hi) - greatest(t.lo, g.lo) as qty, g.price_unit from takers t join givers g
        on g.product_id = t.product_id and g.lo < t.hi and t.lo < g.hi where g.hi > g.lo""",
    "fixed": """
        select m.id, m.product_id, true as is_taker, m.is_in, m.rem * m.price_unit as old_value, m.rem + x.q as rem, case when m.rem + x.q = 0 then 0 else m.rem * m.price_unit + x.v end as val, x.v as taken
        from mv m join (select taker_id, sum(qty) as q, sum(qty * price_unit) as v from alloc group by all) x on x.taker_id = m.id
        union all select m.id, m.product_id, false, m.is_in, m.rem * m.price_unit, m.rem - x.q, m.rem * m.price_unit - x.v, null
        from mv m join (select giver_id, sum(qty) as q, sum(qty * price_unit) as v from alloc group by all) x on x.giver_id = m.id""",
}



def _after_confirmation() -> dict[str, str]:
    """The requisition parts once more, over orders and lines as the confirmation of the run date leaves them."""
    parts = {
        "so_after": """
            select so.id, so.name, so.partner_id, so.company_id, so.date_order, coalesce(c.date_delivery, so.date_delivery) as date_delivery, coalesce(c.state, so.state) as state,
              so.is_duplicate, so.requisitioned, coalesce(c.confirmation_date, so.confirmation_date) as confirmation_date from so left join ord_chg c on c.id = so.id""",
        "sol_after": "select id, order_id, product_id, qty, company_id from sol",
    }
    names = ("req_so", "stg", "dem", "waiting", "net0", "net", "ropt", "rhead")
    renamed = {"so": "so_after", "sol": "sol_after", **{name: f"{name}_after" for name in names}}
    for name in names:
        text = re.sub(r"\b[a-z_0-9]+\b(?!\.)", lambda m: renamed.get(m.group(), m.group()), PARTS[name])
        parts[f"{name}_after"] = text.replace(CONFIRMED, RUN)
    return parts


PARTS |= _after_confirmation()

_TABLE_VIEWS = {
    "stock_location": "loc", "stock_warehouse": "wh", "warehouse_product_rel": "wh_prod", "ofc_locations": "ofc_loc", "location_product_rel": "loc_prod",
    "stock_move": "mv", "product_uom": "uom", "stock_picking": "picking", "stock_picking_type": "ptype", "stock_quant": "quant",
    "stock_warehouse_orderpoint": "opoint", "stock_exceptions": "exc", "product_product": "prod", "product_template": "tmpl", "product_category": "cat",
    "sale_order": "so", "sale_order_line": "sol", "sale_order_tax": "sol_tax", "res_partner": "partner", "res_company": "company",
    "account_voucher": "voucher", "account_invoice_line": "inv_ln", "account_tax": "tax", "product_taxes_rel": "tmpl_tax", "account_account": "account",
    "account_journal": "region", "ir_property": "prop", "ofs_delivery": "dlv", "ofs_cancel_order": "creq", "receipt_document": "doc", "receipt_invoice": "idoc", "wkf_instance": "wkf",
}

_QUERIES = {
    "a1_domain_scan": " union all ".join(f"select '{t}' as table_name, count(*) as rows from {v}" for t, v in _TABLE_VIEWS.items()),
    "a2_ensure_columns": "select id, ofc_id, null::int as previousagentorders, null::int as previouscustorders, false as is_bulk from sol",
    "a3_update_from": """
        select id, product_id, coalesce((select min(location_id) from loc_prod r where r.product_id = sol.product_id), ofc_location_id) as ofc_location_id from sol""",
    "a4_apply_changes": """
        select so.id, coalesce(c.state, so.state) as state, coalesce(c.confirmation_date, so.confirmation_date) as confirmation_date,
          coalesce(c.date_delivery, so.date_delivery) as date_delivery, c.note from so left join ord_chg c on c.id = so.id""",
    "a6_document_numbers": """
        select id, 1000 + 3 * (n - 1) as document_no, 'SO/2001-7-30/' || (1000 + 3 * (n - 1)) as document_name
        from (select id, row_number() over (order by date_order, id) as n from so)""",
    "a6_next_counter": "select 1000 + 3 * count(*) as number_next from so",
    "b1_datediff": """
        select o_orderkey, unit, case unit when 'year' then year(e) - year(s) when 'm' then (year(e) - year(s)) * 12 + month(e) - month(s)
          when 'ww' then trunc(trunc(us / 8.64e10) / 7) when 'day' then trunc(us / 8.64e10) when 'hh' then trunc(us / 3.6e9) when 'mi' then trunc(us / 6e7)
          else trunc(us / 6e7) * 60 + round_even((us - trunc(us / 6e7) * 6e7) / 1e6, 0) end::int as diff
        from (select o_orderkey, s, e, epoch_us(e) - epoch_us(s) as us, unnest(['year', 'm', 'ww', 'day', 'hh', 'mi', 'second']) as unit
          from (select o_orderkey, o_orderdate as s, timestamp '2000-03-01 07:30:15.6' + to_seconds(o_orderkey * 7919 % 100000) as e from orders))""",
    "b2_new_delivery_date": f"""
        select id, case when dayofweek(d) = 0 then d + 1 else d end as delivery from (
          select id, ({RUN} + (id % 7)::int) + case when date_delivery - date_order between 1 and 7 then (date_delivery - date_order)::int - 1 else 0 end as d from so)""",
    "b3_tax_amount": """
        select sol.id, (case kind when 'percent' then price_unit * qty / (1.08 + rate) * rate when 'fixed' then rate * qty end)::decimal(12,2) as tax
        from sol join tax on tax.id = 1 + sol.id % 4""",
    "b4_property_keys": """
        select p.id, 'res.partner,' || p.id as res_id, try_cast(replace(r.ref, 'account.account,', '') as int) as account_id
        from partner p left join prop r on r.name = 'property_account_receivable_id' and r.res_id = 'res.partner,' || p.id""",
    "b5_business_calendar": """
        select event_id, d as day, dayofweek(d) <> 0 as runs, d - case dayofweek(d) when 1 then 3 else 2 end as cutoff
        from (select event_id, (ts + interval 3 hour)::date as d from events)""",
    "b6_expand_prefix": "select id, case when id % 10 <> 0 then 'SO/' || year(date_order) || '/' || month(date_order) || '/' || day(date_order) || '/' || id end as name from so",
    "b7_labels": "select id, code || ' - ' || name as dashed, '[' || coalesce(code, '') || '] ' || coalesce(name, '') as bracketed from tmpl",
    "b8_round2": "select id, (rem * price_unit * 0.125)::decimal(18,6)::decimal(18,2) as amount from mv",
    "b9_fixed_scale": "select id, (price_unit * qty * 0.025)::decimal(18,5)::decimal(12,2) as cents, round((price_unit * qty * 0.025)::decimal(18,5))::int as whole from sol",
    "b10_posting_text": "select id, left(repeat(name || ' / ', 9), 64) as name, replace(repeat(name || ' / ', 9), '/', '') as ref from tmpl",
    "c1_location_closure": "select a as ancestor_id, d as descendant_id, name, complete_name from tree",
    "c2_warehouse_locations": """
        select wh.id as warehouse_id, t as location_type, case t when 'customer' then 2 when 'supplier' then 3 when 'loss' then 4 when 'Inventory loss' then 4
          when 'Scrapped' then 5 when 'stock' then stock_id when 'output' then output_id when 'input' then input_id end as location_id
        from wh, (values ('customer'), ('supplier'), ('procurement'), ('production'), ('loss'), ('Inventory loss'), ('Scrapped'), ('stock'), ('output'), ('input')) v(t)""",
    "c3_picking_type": """
        select r.id, (select min(t.id) from ptype t where t.active and t.warehouse_id = r.w and t.code = r.code and coalesce(t.src, r.s) = r.s and coalesce(t.dest, r.d) = r.d) as picking_type_id
        from (select id, ofc_id as w, case when id % 3 = 0 then 'incoming' else 'outgoing' end as code, case id % 3 when 0 then 3 when 1 then 1000 + ofc_id else 1001 + ofc_id end as s,
          case id % 5 when 0 then null when 1 then 2 else 1000 + ofc_id end as d from sol) r""",
    "c4_fulfilment_center": """
        select l.id, case when w.parent_id is null or h.product_id is not null then l.ofc_id else w.parent_id end as ofc_id
        from sol l left join wh w on w.id = l.ofc_id left join held h on h.warehouse_id = l.ofc_id and h.product_id = l.product_id""",
    "c5_item_location": """
        select l.id, coalesce(a.place, d.place) as ofc_location_id from sol l left join assigned a on a.warehouse_id = l.ofc_id and a.product_id = l.product_id
        left join deflt d on d.warehouse_id = l.ofc_id""",
    "c6_properties": """
        select p.id, coalesce(nullif(replace(r.ref, 'account.account,', ''), ''), '699')::int as account_id, coalesce(nullif(t.txt, ''), '42') as p_text,
          coalesce(t.num, 42)::int as p_integer, coalesce(t.flt, 42.0) as p_float, coalesce(t.dt::date, try_cast('42' as date)) as p_datetime
        from partner p left join prop r on r.name = 'property_account_receivable_id' and r.res_id = 'res.partner,' || p.id
        left join prop t on t.name = 'property_limit' and t.res_id = 'res.partner,' || p.id""",
    "c7_client_vendor": "select customer_id, case when count(distinct partner_id) = 1 then max(partner_id) end as vendor_id from so group by customer_id",
    "c8_account_and_currency": """
        select so.id, a.user_type_id, c.currency_id, 690::bigint as sale_account from so left join account a on a.id = 690 + so.partner_id left join company c on c.id = so.company_id""",
    "c9_agent_warehouse": "select so.id, so.partner_id, case when so.partner_id = 0 then 1 else p.warehouse_id end as warehouse_id from so left join partner p on p.id = so.partner_id",
    "c10_product_matrix": """
        select r.warehouse_id, w.name as warehouse_name, w.parent_id as parent_warehouse_id, pw.name as parent_name, r.product_id, t.name as product_name
        from wh_prod r join wh w on w.id = r.warehouse_id join prod p on p.id = r.product_id join tmpl t on t.id = p.tmpl_id and t.sale_ok left join wh pw on pw.id = w.parent_id""",
    "c11_line_enrichment": """
        select l.id, l.order_id, l.product_id, l.order_partner_id, o.name as order_name, o.partner_id, p.tmpl_id as product_tmpl_id, t.tier_id as commissiontier_id, t.categ_id, a.agent_type_id, g.route_id
        from sol l left join so o on o.id = l.order_id left join prod p on p.id = l.product_id left join tmpl t on t.id = p.tmpl_id left join partner a on a.id = l.order_partner_id left join partner g on g.id = o.partner_id""",
    "d1_qty_on_hand": "select a as location_id, product_id, qty as qty_on_hand from on_hand",
    "d1_qty_on_hand_tree": "select a as location_id, product_id, qty as qty_on_hand from on_hand_tree",
    "d2_stock_flow_report": """
        select i.a as location_id, i.product_id, c.code as default_code, c.name, sum(i.q - o.q)::decimal(18,2) as qoh, sum(i.q)::decimal(18,2) as qty_in, sum(o.q)::decimal(18,2) as qty_out
        from (select a, product_id, uom_id, sum(q) as q from flow_in where state = 'done' group by all) i
        join (select a, product_id, uom_id, sum(q) as q from flow_out where state = 'done' group by all) o on o.a = i.a and o.product_id = i.product_id
        join prod c on c.id = i.product_id where c.id in (select min(id) from prod where active and code is not null group by code) group by all""",
    "d3_pending_in": "select a as location_id, product_id, qty as pending_in from incoming",
    "d4_pending_out": "select warehouse_id, product_id, qty as pending_out from open_demand",
    "d5_available_qoh": "select warehouse_id, product_id, qty as available_qoh from avail",
    "d6_available_by_warehouse": """
        select r.warehouse_id, r.product_id, w.name as warehouse_name, coalesce(a.qty, 0)::decimal(12,2) as available_qoh
        from wh_prod r join wh w on w.id = r.warehouse_id left join avail a on a.warehouse_id = r.warehouse_id and a.product_id = r.product_id""",
    "d6_available_for_product": """
        select w.id as warehouse_id, 7::bigint as product_id, w.name as warehouse_name, coalesce(a.qty, 0)::decimal(12,2) as available_qoh
        from wh w left join avail a on a.warehouse_id = w.id and a.product_id = 7""",
    "d7_expected_qoh": """
        select q.*, coalesce(a.qty, 0)::decimal(12,2) as expected_qoh from (
          select r.partner_id, r.product_id, r.warehouse_id, case when w.parent_id is null or h.product_id is not null then r.warehouse_id else w.parent_id end as ofc_id
          from (select distinct o.partner_id, l.product_id, case when o.partner_id = 0 then 1 else p.warehouse_id end as warehouse_id from sol l join so o on o.id = l.order_id left join partner p on p.id = o.partner_id) r
          left join wh w on w.id = r.warehouse_id left join held h on h.warehouse_id = r.warehouse_id and h.product_id = r.product_id) q
        left join avail a on a.warehouse_id = q.ofc_id and a.product_id = q.product_id""",
    "d8_stock_per_location": """
        select 4 as level, location_id::varchar as line_id, 'product_' || product_id as parent_id, product_id, complete_name as name, location_id, qty::decimal(18,2) as qty from bal
        union all select 2, 'product_' || product_id, null, product_id, code_name, null, sum(qty)::decimal(18,2) from bal group by product_id, code_name
        union all select 0, 'grouped_products_total', null, null, 'Total', null, sum(qty)::decimal(18,2) from bal""",
    "d9_previous_agent_orders": "select partner_id, count(*) as previous_orders from so where state = 'done' and is_duplicate = false group by all",
    "d10_previous_customer_orders": "select customer_id, count(*) as previous_orders from so where state = 'done' and is_duplicate = false group by all",
    "d11_order_prepayment": "select order_id, sum(amount)::decimal(18,4) as prepayment from voucher where state = 'booked' group by all",
    "d12_fully_invoiced": """
        select o.id as order_id, a.q::int as ordered, i.q::int as invoiced, case when a.q > i.q then false else true end as fully_invoiced
        from so o left join (select order_id, sum(qty) as q from sol where state <> 'cancel' group by all) a on a.order_id = o.id
        left join (select l.order_id, sum(v.quantity) as q from inv_ln v join sol l on l.id = v.order_line_id group by all) i on i.order_id = o.id""",
    "d13_product_origins": "select product_id, string_agg(order_name, ', ' order by order_id, id) as origin from stg group by product_id",
    "d13_order_names_by_product": "select l.product_id, l.order_id, o.name as order_name, count(*) as line_count from sol l join so o on o.id = l.order_id group by all",
    "d14_pending_orders": f"""
        select l.product_id, sum(l.qty)::int as pending_qty from sol l join so o on o.id = l.order_id
        where o.state = 'progress' and o.date_delivery > {DEMAND} and o.date_order < {DEMAND} and o.confirmation_date < {RUN} group by all""",
    "d15_line_cost": "select line as order_line_id, qty as quant_qty, total as quant_total, cost as line_cost from lcost",
    "e1_confirm_candidates": "select id, name, partner_id, date_order from cand",
    "e2_empty_orders": "select id, name from cand where id not in (select order_id from known_ln)",
    "e3_order_line_facts": """
        select k.id, k.order_id, k.product_id, (k.qty * k.w100 / 100)::decimal(12,4) as weight, (k.size = 'big' or k.qty * k.w100 >= 1000) and c.parent_id not in (354, 352) as is_bulk,
          w.w as default_ofc_id, f.ofc as ofc_id, coalesce(a.place, d.place) as ofc_location_id,
          (select count(*) from so x where x.state = 'done' and x.is_duplicate = false and x.partner_id = o.partner_id) as previousagentorders,
          (select count(*) from so x where x.state = 'done' and x.is_duplicate = false and x.customer_id = o.partner_id) as previouscustorders
        from known_ln k join cand o on o.id = k.order_id join cat c on c.id = k.categ_id left join partner p on p.id = o.partner_id,
        lateral (select case when o.partner_id = 0 then 1 else p.warehouse_id end as w) w
        left join wh on wh.id = w.w left join held h on h.warehouse_id = w.w and h.product_id = k.product_id,
        lateral (select case when wh.parent_id is null or h.product_id is not null then w.w else wh.parent_id end as ofc) f
        left join assigned a on a.warehouse_id = f.ofc and a.product_id = k.product_id left join deflt d on d.warehouse_id = f.ofc""",
    "e3_refilled_locations": """
        select l.id, coalesce(l.ofc_location_id, a.place, d.place) as ofc_location_id from sol l left join assigned a on a.warehouse_id = l.ofc_id and a.product_id = l.product_id
        left join deflt d on d.warehouse_id = l.ofc_id""",
    "e4_high_value": "select order_id, amount, dear or amount >= 10000 as high from hv",
    "e5_disposition": "select order_id, amount, paid as prepayment, disposition from disp",
    "e6_order_changes": "select id, state, note, confirmation_date, date_delivery from ord_chg",
    "e6_line_changes": """
        select l.id, case d.disposition when 'confirm' then 'confirmed' else 'cancel' end as state from sol l join disp d on d.order_id = l.order_id where d.disposition in ('confirm', 'cancel_unpaid')""",
    "e6_workflow_changes": """
        select id, 'active' as state from wkf where res_type = 'sale.order' and state <> 'active' and res_id in (select order_id from disp where disposition = 'confirm')""",
    "e7_requisition_orders": "select id, name, partner_id, company_id, date_order, date_delivery, warehouse_id from req_so",
    "e8_requisition_demand": """
        select d.product_id, d.company_id, d.uom_po_id as purchase_uom_id, d.ofc as warehouse_id, d.factor::decimal(10,6) as purchase_factor, d.po_qty as po_qty_ordered, d.qty as qty_ordered,
          t.categ_id, t.code as default_code, '[' || coalesce(t.code, '') || '] ' || t.name as product_name, c.name as category_name
        from dem d join prod p on p.id = d.product_id join tmpl t on t.id = p.tmpl_id left join cat c on c.id = t.categ_id""",
    "e9_net_purchase_qty": """
        select product_id, company_id, uom_po_id as purchase_uom_id, ofc as warehouse_id, stock_id as location_id, po_qty as po_qty_ordered, onhand as qtyonhand, po_onhand as po_qtyonhand,
          p_in as pending_in, p_out as pending_out, case when gap > 0 then round(gap)::int else 0 end as topurchase_qty from net""",
    "e10_reorder_qty": """
        select product_id, company_id, uom_po_id as purchase_uom_id, ofc as warehouse_id, min_qty as product_min_qty, max_qty as product_max_qty, projected as projected_qty,
          (case when projected <= min_qty then max_qty - projected else 0 end)::decimal(12,4) as required_qty,
          (case when projected <= min_qty then floor((max_qty - projected) / multiple * factor) else 0 end)::decimal(12,4) as reorder_qty from ropt""",
    "e11_requisition_headers": """
        select h.no as requisition_no, 'PR2001-' || h.no || '(' || coalesce(w.name, '') || ')' as name, 'SOs for 31 Dec 1997' as origin, h.ofc as warehouse_id, h.company_id
        from rhead h left join wh w on w.id = h.ofc""",
    "e11_requisition_lines": """
        select h.no as requisition_no, r.product_id, r.uom_po_id as product_uom_id, r.company_id, c.name as category,
          (case when projected <= min_qty then floor((max_qty - projected) / multiple * factor) else 0 end)::decimal(12,4) as reorder_qty,
          case when gap > 0 then round(gap)::int else 0 end as qty_to_purchase, r.po_qty as product_qty, r.po_onhand as qty_available
        from ropt r join rhead h on h.ofc = r.ofc and h.company_id = r.company_id join prod p on p.id = r.product_id join tmpl t on t.id = p.tmpl_id left join cat c on c.id = t.categ_id""",
    "e11_requisition_line_orders": """
        select l.requisition_no, s.product_id, s.order_id, coalesce(max(s.order_name), '') as order_name, count(*) as line_count
        from (select distinct h.no as requisition_no, r.product_id from ropt r join rhead h on h.ofc = r.ofc and h.company_id = r.company_id) l
        join stg s on s.product_id = l.product_id group by l.requisition_no, s.product_id, s.order_id""",
    "e12_confirm_and_requisition": """
        select h.no - 99 as requisition_no, r.product_id, r.uom_po_id as product_uom_id, r.company_id, case when gap > 0 then round(gap)::int else 0 end as qty_to_purchase, r.po_qty as product_qty
        from ropt_after r join rhead_after h on h.ofc = r.ofc and h.company_id = r.company_id""",
    "e13_intake_receipts": "select distinct warehouse_id, receipt_id from dlv where not processed",
    "e14_duplicate_deliveries": "select id, processed or is_dup as processed, case when is_dup then 'possible duplicate' end as remarks from dup",
    "e15_cancelled_lines": """
        select l.id, case when by_request is not null then 'cancel' else l.state end as state, greatest(l.qty - cut, 0)::int as product_uom_qty,
          (case when cut = 0 then l.commission else 0 end)::decimal(12,2) as commission, c.user_id as write_uid from can_ln l left join creq c on c.id = l.by_request""",
    "e15_proportional_commission": """
        select id, greatest(qty - cut, 0)::int as product_uom_qty, (commission * greatest(qty - cut, 0) / qty)::decimal(12,2) as commission from can_ln""",
    "e15_split_lines": """
        select id as request_id, line_id as original_line, order_id, product_id, cancelled_qty::int as product_uom_qty, 'cancel' as state, 0::decimal(12,2) as commission, user_id as create_uid
        from cr where cancelled_qty < ordered and here""",
    "e15_split_taxes": "select c.id as request_id, t.tax_id from cr c join sol_tax t on t.order_line_id = c.line_id where c.cancelled_qty < c.ordered and c.here",
    "e15_order_changes": """
        select order_id as id, 'cancel' as state, arg_max(user_id, id) as write_uid from creq c where order_id in (select id from so)
          and not exists (select 1 from can_ln l where l.order_id = c.order_id and l.state = 'confirmed' and l.by_request is null) group by order_id""",
    "e16_repeated_receipts": """
        select id, true as processed, 'Duplicate Stock Picking Detected' as remarks from dlv d where not processed
          and exists (select 1 from doc where doc.warehouse_id = d.warehouse_id and doc.receipt_id = d.receipt_id and doc.state <> 'cancel')""",
    "e17_kitting_lines": """
        select k.delivery_id, k.warehouse_id, k.receipt_id, k.line as order_line_id, k.order_id, k.order_name, k.partner_id, k.company_id, k.product_id, k.product_name, k.uom_id as product_uom,
          k.ordered_qty, k.qty as product_uom_qty, k.weight, k.agent as default_ofc_id, h.qoh as product_qoh, k.receipt_ref, k.date_delivery as date_expected
        from kit k join kqoh h on h.warehouse_id = k.warehouse_id and h.receipt_id = k.receipt_id and h.product_id = k.product_id""",
    "e17_receipt_totals": "select warehouse_id, receipt_id, weight, items, order_id, order_name, partner_id, company_id, receipt_ref, agent as agent_warehouse_id from rtot",
    "e17_invalid_receipts": """
        select id, true as processed, 'invalid order' as remarks from fresh f where not processed and not exists (select 1 from kit k where k.warehouse_id = f.warehouse_id and k.receipt_id = f.receipt_id)""",
    "e18_stock_exceptions": f"""
        select e.warehouse_id, e.product_id, e.sync_date, e.state, e.initial_qoh, case when m.q is null then e.kitted_qty else e.kitted_qty + m.q end::bigint as kitted_qty, case when m.q is null then e.adjusted_qty else 0 end as adjusted_qty
        from exc e left join kq m on m.warehouse_id = e.warehouse_id and m.product_id = e.product_id and e.state = 'new' and e.sync_date = {RUN}
        union all select m.warehouse_id, m.product_id, {RUN}, 'new', m.qoh, m.q::bigint, 0 from kq m where not m.known and m.q is not null""",
    "e19_consumed_quants": "select delivery_id as demand_id, line as order_line_id, quant_id, q::decimal(18,4) as quant_qty, unit_cost as quant_cost from used",
    "e19_lot_moves": """
        select u.quant_id, k.warehouse_id, k.receipt_id, u.delivery_id, 1 as leg, u.q::decimal(18,4) as quant_qty, u.quant_id is null as negative from used u join kit k on k.delivery_id = u.delivery_id""",
    "e19_lot_changes": """
        select q.id, (q.quantity - x.q)::decimal(18,4) as quantity from quant q join (select quant_id, sum(q) as q from used where quant_id is not null group by quant_id) x on x.quant_id = q.id""",
    "e20_transfer_headers": f"""
        select warehouse_id, receipt_id, leg, no as document_no, case when leg = 3 then 'OUT' else 'INT' end || '/2001/' || no as name, order_name as origin, 'sale,order,' || order_id as ref,
          partner_id, company_id, ptype_id as picking_type_id, src as location_id, dest as location_dest_id, state, weight, receipt_ref, {RUN} as date from thead""",
    "e20_transfer_moves": """
        select m.warehouse_id, m.receipt_id, m.delivery_id, m.leg, m.line as order_line_id, m.product_id, m.uom_id as product_uom, m.qty as product_qty, m.ordered_qty, coalesce(c.cost, 0)::decimal(12,4) as price_unit,
          m.company_id, m.partner_id, m.ptype_id as picking_type_id, m.src as location_id, m.dest as location_dest_id, m.state, m.order_name as origin, m.weight from tmove m left join lcost c on c.line = m.line""",
    "e21_chained_moves": """
        select a.warehouse_id, a.receipt_id, a.delivery_id, a.leg, b.leg as next_leg from tmove a join tmove b on b.delivery_id = a.delivery_id and b.leg <> a.leg and b.src = a.dest""",
    "e21_closed_deliveries": """
        select f.id, true as processed, 'processed successfully' as remarks, 'INT/2001/' || a.no as picking_int, 'INT/2001/' || t.no as transit_int, 'OUT/2001/' || c.no as picking_out
        from fresh f join thead a on a.warehouse_id = f.warehouse_id and a.receipt_id = f.receipt_id and a.leg = 1
        left join thead t on t.warehouse_id = f.warehouse_id and t.receipt_id = f.receipt_id and t.leg = 2
        join thead c on c.warehouse_id = f.warehouse_id and c.receipt_id = f.receipt_id and c.leg = 3 where not f.processed""",
    "e16_invoiced_receipts": """
        select r.warehouse_id, r.receipt_id, r.order_id from rord r
        where exists (select 1 from idoc i where i.warehouse_id = r.warehouse_id and i.receipt_id = r.receipt_id and i.state <> 'cancel')""",
    "e22_invoice_lines": """
        select warehouse_id, receipt_id, line as order_line_id, order_id, product_id, name as product_name, uom_id as product_uom, price_unit, quantity, tax_sum as tax, gross,
          (gross - tax_sum)::decimal(10,2) as price_subtotal, 0::decimal(10,2) as commission from bline""",
    "e23_line_taxes": """
        select warehouse_id, receipt_id, line as order_line_id, tax_id, tax_name, account_id as tax_account_id, total_rate::decimal(12,6) as total_rate, amount as tax_amount from btax""",
    "e24_invoice_headers": """
        select warehouse_id, receipt_id, number, order_id, partner_id, company_id, currency_id, account_id, user_id, team_id, receipt_ref, date_invoice, total as amount_total, untaxed as amount_untaxed,
          (total - untaxed)::decimal(12,2) as amount_tax, total as residual, 'open' as state, 'out_invoice' as type from bhead""",
    "e25_journal_entries": """
        select warehouse_id, receipt_id, number as name, replace(number, '/', '') as ref, date_invoice as date, company_id, partner_id, currency_id, 'posted' as state from bhead""",
    "e25_journal_lines": """
        select j.warehouse_id, j.receipt_id, j.kind, j.account_id, j.name, j.product_id, j.uom_id as product_uom, j.quantity, j.tax_line_id, j.debit, j.credit, a.user_type_id, (j.debit - j.credit)::decimal(12,2) as balance
        from jline j left join account a on a.id = j.account_id""",
    "e26_tax_summary": "select warehouse_id, receipt_id, line as order_line_id, tax_id, tax_name as name, account_id, amount from btax where amount > 0",
    "e26_line_taxes": "select warehouse_id, receipt_id, line as order_line_id, tax_id from btax",
    "e26_line_orders": "select warehouse_id, receipt_id, line as order_line_id, line as sale_order_line_id from bline",
    "e27_invoiced_deliveries": "select f.id, b.number as invoice from fresh f join bhead b on b.warehouse_id = f.warehouse_id and b.receipt_id = f.receipt_id",
    "e28_fifo_allocations": """
        select product_id, 1::bigint as company_id, taker_id, giver_id, qty::decimal(18,6) as qty, (qty * price_unit)::decimal(18,6) as value from alloc""",
    "e28_fifo_moves": """
        select id, product_id, is_taker, old_value::decimal(18,6) as old_value, rem::decimal(18,6) as remaining_qty, val::decimal(18,6) as remaining_value, taken::decimal(18,6) as taken_value from fixed""",
    "e29_valuation_corrections": """
        select f.id, f.product_id, (case when f.is_in then -1 else 1 end * (taken::decimal(18,2) + case when old_value < 0 then old_value::decimal(18,2) else 0 end))::decimal(18,2) as amount
        from fixed f join prod p on p.id = f.product_id and p.real_time where f.is_taker""",
}

STATEMENTS = {name: statement(text, PARTS) for name, text in _QUERIES.items()}

STREAM_STATEMENTS: dict[str, str] = {
    "s1_event_intake": """
        with d as (select event_id as id, user_id % 10 as warehouse_id, hour(ts) as receipt_id, case when event_type <> 'error' then user_id end as line_id, (event_id % 3)::int as qty
          from events where event_id % 7 <> 0)
        select * from d where line_id is null or id in (select min(id) from d group by warehouse_id, receipt_id, line_id, qty)""",
    "s2_cancellations": statement(
        """
        select id as request_id, line_id as original_line, order_id, cancelled_qty::int as product_uom_qty, 'cancel' as state
        from cr where cancelled_qty < ordered and here""",
        PARTS,
    ),
}

__all__ = ["PARTS", "STATEMENTS", "STREAM_STATEMENTS", "VIEWS"]
