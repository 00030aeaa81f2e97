"""Plain SQL over the given tables that must return what each catalog query returns.

Written for DuckDB and, on purpose, in another shape than the Spark code: joins for running sums,
recursion for folds.
"""

from __future__ import annotations

import re

from ledgerloom.operators.metering import EXPECTED_OUTCOMES
from ledgerloom.schemas import IDENTITY_KEYS, MESSAGES, SCHEMAS, TABLES
from ledgerloom.sources.synthetic import CATEGORIES, DAY, HOUR, PRODUCTS, START_TS

# --- views: name -> SQL; a query gets the views it names, in this order ---------------------------

VIEWS: dict[str, str] = {
    "r_lines": """
select l_orderkey as order_id,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
    l_shipdate, l_extendedprice, l_quantity, l_returnflag, l_linestatus, l_discount, l_tax) as bigint)
    as line_id,
  l_partkey as product_id, cast(l_quantity as bigint) as quantity,
  cast(floor(round(l_extendedprice*100)/l_quantity) as bigint) as unit_price_cents,
  l_returnflag as rf
from lineitem""",
    "f_lines": """
select r.order_id, r.line_id, r.product_id,
  case when r.order_id%307=0 and r.line_id=1 then 0 else r.quantity end as quantity,
  r.unit_price_cents,
  r.quantity*r.unit_price_cents
    + case when r.order_id%101=0 and r.line_id=1 then 1 else 0 end as line_total_cents
from r_lines r
union all
select -r.order_id-1, r.line_id, r.product_id, r.quantity, r.unit_price_cents,
  r.quantity*r.unit_price_cents
from r_lines r where r.order_id%401=0 and r.line_id=1
union all
select r.order_id, r.line_id, r.product_id, r.quantity, r.unit_price_cents,
  r.quantity*r.unit_price_cents
from r_lines r where r.order_id%701=0 and r.line_id=2""",
    "r_sub": """
select order_id, cast(sum(quantity*unit_price_cents) as bigint) as s from r_lines group by order_id""",
    "r_orders": """
select o_orderkey as order_id, o_custkey as customer_id, o_custkey%3 as store_id,
  cast(floor(epoch(o_orderdate)) as bigint) as order_ts,
  case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'OPEN' else 'PENDING' end as status,
  coalesce(s,0) as subtotal_cents, cast(floor(coalesce(s,0)*18/100) as bigint) as tax_cents,
  cast(case when o_orderkey%10=0 then 100 else 0 end as bigint) as discount_cents
from orders left join r_sub on o_orderkey=order_id""",
    "f_orders": """
select order_id, customer_id, store_id, order_ts, status, subtotal_cents, tax_cents, discount_cents,
  subtotal_cents+tax_cents-discount_cents
    + case when order_id%97=0 then 1 else 0 end as total_cents,
  case when order_id%113=0 then 'EUR' else 'INR' end as currency
from r_orders
union all
select order_id, customer_id, store_id, order_ts, status, subtotal_cents, tax_cents, discount_cents,
  subtotal_cents+tax_cents-discount_cents, 'INR' from r_orders where order_id%499=0""",
    "f_payments": """
select order_id as payment_id,
  case when order_id%211=0 then -order_id-1 else order_id end as order_id,
  subtotal_cents+tax_cents-discount_cents as amount_cents,
  case when order_id%103=0 then 'AUTHORIZED' else 'CAPTURED' end as status
from r_orders
union all
select order_id, order_id, cast(0 as bigint), 'AUTHORIZED' from r_orders where order_id%607=0""",
    "f_returns": """
select order_id*100+line_id as return_id,
  case when order_id%331=0 then -order_id-7 else order_id end as order_id, line_id,
  case when order_id%51=0 then quantity+1 when order_id%269=0 then 0 else 1 end as quantity,
  case when order_id%85=0 then 100000000000 else unit_price_cents end as refund_cents
from r_lines where rf='R' and (order_id%17=0 or order_id%331=0 or order_id%269=0)
union all
select order_id*100+line_id, order_id, line_id, cast(1 as bigint), unit_price_cents
from r_lines where rf='R' and order_id%119=0""",
    "f_movements": """
select cast(-1 as bigint)*(p_partkey*3+s.store_id)-1 as movement_id, p_partkey as product_id,
  s.store_id as store_id,
  cast(case when p_partkey%29=0 then 5 else 1000000 end as bigint) as quantity_delta,
  'OPENING' as reason, cast(788918399 as bigint) as movement_ts
from part cross join (select distinct o_custkey%3 as store_id from orders) s
union all
select cast(-1 as bigint)*(p_partkey*3)-1, p_partkey, cast(100 as bigint), cast(0 as bigint),
  'OPENING', cast(788918399 as bigint)
from part where p_partkey%59=0
union all
select l.order_id*100+l.line_id, l.product_id, o.store_id, -l.quantity, 'SALE', o.order_ts
from r_lines l join r_orders o on l.order_id=o.order_id
union all
select -(l.order_id*100+l.line_id)-100000000, l.product_id, o.store_id, cast(1 as bigint), 'RETURN',
  o.order_ts+5
from r_lines l join r_orders o on l.order_id=o.order_id where l.rf='R' and l.order_id%17=0""",
    "f_products": """
select p_partkey as product_id, p_type as category, cast(700000000 as bigint) as effective_from,
  case when p_partkey%2=0 then cast(880000000 as bigint) end as effective_to,
  cast(700000000 as bigint) as loaded_at
from part where p_partkey%97<>0
union all
select p_partkey, concat('V2-',p_type), 880000000, cast(null as bigint),
  case when p_partkey%83=0 then 999999999 else 880000000 end
from part where p_partkey%2=0 and p_partkey%97<>0
union all
select p_partkey, 'overlap', 700000001, cast(null as bigint), 700000001 from part where p_partkey%89=0
union all
select p_partkey, 'dup', cast(700000000 as bigint), cast(null as bigint), cast(700000000 as bigint)
from part where p_partkey%79=0""",
    "f_log": """
select user_id%10 as pointer_id, user_id as batch_id, event_id as seq,
  cast(floor(epoch(ts)) as bigint) as ts,
  case event_type when 'signup' then 'register' when 'view' then 'start_build'
    when 'click' then 'validate' when 'purchase' then 'publish' else 'fail' end as action,
  concat(case when event_id%11=0 then 'd2-' else 'd1-' end, cast(user_id as varchar))
    as manifest_digest,
  concat('loc-', cast(case when event_id%13=0 then 1 else 0 end as varchar)) as manifest_version_id,
  event_id%4 as expected_pointer_version
from events""",
    "v_valid_returns": """
select r.* from f_returns r semi join f_lines l on r.order_id=l.order_id and r.line_id=l.line_id""",
    "v_captured": """
select order_id, cast(sum(amount_cents) as bigint) as captured_cents
from f_payments where status='CAPTURED' group by order_id""",
    "v_times": "select order_id, max(order_ts) as order_ts from f_orders group by order_id",
    "v_events": """
select distinct l.order_id, l.line_id, l.product_id, t.order_ts
from f_lines l join v_times t on l.order_id=t.order_id""",
    "v_matches": """
select e.*, v.category, v.effective_from, v.effective_to, v.loaded_at, v.product_id as matched
from v_events e left join f_products v on e.product_id=v.product_id
  and v.effective_from<=e.order_ts and (v.effective_to is null or e.order_ts<v.effective_to)
  and v.loaded_at<=996000000""",
    "v_counts": """
select order_id, line_id, product_id, order_ts, count(matched) as n,
  max(category) as category, max(effective_from) as effective_from,
  max(effective_to) as effective_to, max(loaded_at) as loaded_at
from v_matches group by order_id, line_id, product_id, order_ts""",
    "v_stock": """
select *, cast(sum(quantity_delta) over (partition by product_id, store_id
  order by movement_ts, movement_id rows unbounded preceding) as bigint) as stock
from f_movements""",
    "v_ordered": """
select order_id, line_id, max(quantity) as ordered_quantity from f_lines group by order_id, line_id""",
}

VIEW_OF_TABLE = {
    "orders": "f_orders",
    "order_lines": "f_lines",
    "payments": "f_payments",
    "returns": "f_returns",
    "inventory_movements": "f_movements",
    "products": "f_products",
}

# --- gates -----------------------------------------------------------------------------------------


def _gate(code: str, entity: str, body: str) -> str:
    return (
        f"select '{code}' as code, cast({entity} as varchar) as entity_id, "
        f"'{MESSAGES[code]}' as message from {body}"
    )


def _duplicates() -> str:
    words = {
        "orders": "order",
        "order_lines": "line",
        "payments": "payment",
        "returns": "return",
        "inventory_movements": "movement",
        "products": "product",
    }
    parts = []
    for table, keys in IDENTITY_KEYS.items():
        columns = ", ".join(keys)
        parts.append(
            f"select 'DUPLICATE_ID' as code, concat_ws(':', {columns}) as entity_id, "
            f"'duplicate {words[table]} identity' as message "
            f"from {VIEW_OF_TABLE[table]} group by {columns} having count(*)>1"
        )
    return " union all ".join(parts)


GATE_SQL: dict[str, str] = {
    "DUPLICATE_ID": _duplicates(),
    "INVALID_LINE": _gate(
        "INVALID_LINE",
        "line_id",
        "f_lines where not coalesce(quantity>0 and unit_price_cents>=0, false)",
    ),
    "LINE_TOTAL": _gate(
        "LINE_TOTAL",
        "line_id",
        "f_lines where not coalesce(line_total_cents=quantity*unit_price_cents, false)",
    ),
    "ORDER_SUBTOTAL": _gate(
        "ORDER_SUBTOTAL",
        "o.order_id",
        "f_orders o left join (select order_id, sum(line_total_cents) as s from f_lines"
        " group by order_id) t on o.order_id=t.order_id"
        " where not coalesce(coalesce(s,0)=subtotal_cents, false)",
    ),
    "ORDER_TOTAL": _gate(
        "ORDER_TOTAL",
        "order_id",
        "f_orders where not coalesce(total_cents=subtotal_cents+tax_cents-discount_cents, false)",
    ),
    "CURRENCY": _gate(
        "CURRENCY", "order_id", "f_orders where not coalesce(currency in ('INR','USD'), false)"
    ),
    "ORPHAN_PAYMENT": _gate(
        "ORPHAN_PAYMENT",
        "payment_id",
        "f_payments p anti join f_orders o on p.order_id=o.order_id",
    ),
    "UNDERPAID": _gate(
        "UNDERPAID",
        "o.order_id",
        "f_orders o left join v_captured c on o.order_id=c.order_id where status='COMPLETED'"
        " and not coalesce(coalesce(captured_cents,0)>=total_cents, false)",
    ),
    "ORPHAN_RETURN": _gate(
        "ORPHAN_RETURN",
        "return_id",
        "f_returns r anti join f_lines l on r.order_id=l.order_id and r.line_id=l.line_id",
    ),
    "INVALID_RETURN": _gate(
        "INVALID_RETURN",
        "return_id",
        "v_valid_returns where not coalesce(quantity>0 and refund_cents>=0, false)",
    ),
    "RETURN_QUANTITY": _gate(
        "RETURN_QUANTITY",
        "concat_ws(':', r.order_id, r.line_id)",
        "(select order_id, line_id, sum(quantity) as q from v_valid_returns group by all) r"
        " join v_ordered l on r.order_id=l.order_id and r.line_id=l.line_id"
        " where not coalesce(q<=ordered_quantity, false)",
    ),
    "EXCESS_REFUND": _gate(
        "EXCESS_REFUND",
        "r.order_id",
        "(select order_id, sum(refund_cents) as refund from v_valid_returns group by all) r"
        " left join v_captured c on r.order_id=c.order_id"
        " where not coalesce(refund<=coalesce(captured_cents,0), false)",
    ),
    "NEGATIVE_INVENTORY": _gate(
        "NEGATIVE_INVENTORY",
        "concat_ws(':', product_id, store_id)",
        "v_stock where not coalesce(stock>=0, false)",
    ),
    "ORPHAN_LINE": _gate(
        "ORPHAN_LINE", "line_id", "f_lines l anti join f_orders o on l.order_id=o.order_id"
    ),
    "MISSING_DIMENSION": _gate("MISSING_DIMENSION", "product_id", "v_counts where n=0"),
    "AMBIGUOUS_DIMENSION": _gate("AMBIGUOUS_DIMENSION", "product_id", "v_counts where n>1"),
}
VIEWS["v_report"] = " union all ".join(f"({sql})" for sql in GATE_SQL.values())

# --- lifecycle: recursion over numbered actions ---------------------------------------------------

VIEWS["v_numbered"] = """
select *, row_number() over (partition by batch_id order by seq) as n from f_log"""
VIEWS["v_outcomes"] = """
with recursive walk as (
  select batch_id, cast(0 as bigint) as n, cast(null as bigint) as seq, cast(null as varchar) as action,
    'UNREGISTERED' as before, 'UNREGISTERED' as after, false as accepted
  from (select distinct batch_id from f_log)
  union all
  select e.batch_id, e.n, e.seq, e.action, w.after,
    case when e.action='register' and w.after='UNREGISTERED' then 'REGISTERED'
      when e.action='start_build' and w.after in ('REGISTERED','FAILED') then 'BUILDING'
      when e.action='validate' and w.after='BUILDING' then 'VALIDATED'
      when e.action='publish' and w.after='VALIDATED' then 'PUBLISHED'
      when e.action='fail' and w.after in ('REGISTERED','BUILDING','VALIDATED') then 'FAILED'
      else w.after end,
    (e.action='register' and w.after='UNREGISTERED')
      or (e.action='start_build' and w.after in ('REGISTERED','FAILED'))
      or (e.action='validate' and w.after='BUILDING')
      or (e.action='publish' and w.after='VALIDATED')
      or (e.action='fail' and w.after in ('REGISTERED','BUILDING','VALIDATED'))
  from walk w join v_numbered e on e.batch_id=w.batch_id and e.n=w.n+1
) select * from walk where n>0"""
VIEWS["v_registry"] = """
select batch_id, seq as registered_seq, manifest_digest as accepted_digest,
  manifest_version_id as accepted_version_id
from (select *, row_number() over (partition by batch_id order by seq) as place
  from f_log where action='register') where place=1"""
VIEWS["v_later"] = """
select l.batch_id, l.seq, l.manifest_digest, l.manifest_version_id, r.accepted_digest,
  r.accepted_version_id
from f_log l join v_registry r on l.batch_id=r.batch_id
where l.action='register' and l.seq>r.registered_seq"""
VIEWS["v_attempts"] = """
select *, row_number() over (partition by pointer_id order by seq) as n
from f_log where action='publish'"""
VIEWS["v_cas"] = """
with recursive walk as (
  select pointer_id, cast(0 as bigint) as n, cast(0 as bigint) as version, cast(null as bigint) as batch_id,
    cast(null as bigint) as seq, cast(null as bigint) as expected, false as hit
  from (select distinct pointer_id from v_attempts)
  union all
  select a.pointer_id, a.n,
    w.version + case when a.expected_pointer_version=w.version then 1 else 0 end,
    a.batch_id, a.seq, a.expected_pointer_version, a.expected_pointer_version=w.version
  from walk w join v_attempts a on a.pointer_id=w.pointer_id and a.n=w.n+1
) select * from walk where n>0"""
VIEWS["v_active"] = """
select pointer_id, arg_max(batch_id, version) as batch_id, max(version) as pointer_version
from v_cas where hit group by pointer_id"""
VIEWS["v_state"] = "select batch_id, arg_max(after, seq) as state from v_outcomes group by batch_id"

# --- synthetic orders -------------------------------------------------------------------------------


def _draw(index: str, salt: str) -> str:
    mixed = f"(({index})%1000003)*48271+({salt})*69621+21*16807+11"
    return f"((((({mixed})%2147483647)*48271)%2147483647)//1024)%3"


VIEWS["s_orders"] = f"select o_orderkey as i, {_draw('o_orderkey', '0')}+1 as line_count from orders"
VIEWS["s_lines"] = f"""
select i, step, {_draw('i', 'step+1')}+1 as quantity, 1000+((i+step)%50)*37 as price,
  concat('o-', lpad(cast(i as varchar), cast(greatest(8, length(cast(i as varchar))) as integer), '0')) as order_id,
  concat('p-', lpad(cast((i*3+step)%20+1 as varchar), 3, '0')) as product_id,
  concat('s-', lpad(cast(i%3+1 as varchar), 2, '0')) as store_id
from (select *, unnest(range(line_count)) as step from s_orders)"""
VIEWS["s_full"] = """
select i, sub, sub*18//100 as tax, case when i%10=0 then 100 else 0 end as discount
from (select i, cast(sum(quantity*price) as bigint) as sub from s_lines group by i)"""
VIEWS["s_count"] = "select count(*) as n from orders"

# --- web pages as objects ---------------------------------------------------------------------------

_URL = "'^(https?)://([^/?#]+)(/[^?#]*)'"
VIEWS["p_objects"] = f"""
select page_id, regexp_extract(url, {_URL}, 2) as bucket,
  ltrim(regexp_extract(url, {_URL}, 3), '/') as key, cast(page_id as varchar) as version_id,
  cast(octet_length(encode(html)) as bigint) as size_bytes, sha256(html) as sha256, md5(html) as etag
from pages"""
VIEWS["p_declared"] = """
select bucket, key, version_id, case when page_id%7=0 then size_bytes+1 else size_bytes end as size_bytes,
  case when page_id%11=0 then sha256(key) else sha256 end as sha256,
  case when page_id%13=0 then 'changed' else etag end as etag
from p_objects where page_id%17<>0"""
VIEWS["p_stored"] = "select * from p_objects where page_id%19<>0"


def _generation(batch: str, digest: str) -> str:
    safe = f"left(trim(regexp_replace({batch}, '[^A-Za-z0-9_-]', '-', 'g'), '-'), 64)"
    return (
        f"concat('g-', coalesce(nullif({safe}, ''), 'batch'), '-', "
        f"left(sha256(concat({batch}, ':', {digest})), 12))"
    )


# --- table digests ------------------------------------------------------------------------------------


def _json(columns: list[str], changes: dict[str, str] | None = None) -> str:
    pairs = ", ".join(f"'{name}': {(changes or {}).get(name, name)}" for name in sorted(columns))
    return f"cast(to_json({{{pairs}}}) as varchar)"


def _fingerprint(table: str, view: str | None = None) -> str:
    lanes = ", ".join(
        f"coalesce(sum((cast('0x' || substr(h, {1 + 15 * word}, 15) as bigint) >> {shift}) & 1048575), 0)"
        for word in range(4)
        for shift in (40, 20, 0)
    )
    return (
        f"select '{table}' as table_name, count(*) as rows, "
        f"sha256(concat_ws(':', count(*), {lanes})) as fingerprint "
        f"from (select sha256({_json(SCHEMAS[table].names)}) as h from {view or VIEW_OF_TABLE[table]})"
    )


# Digits of a leaf for n rows: one for each power of 16 whose leaves of 1,024 rows are too few.
MOST_DIGITS = 8


def _digits(rows: str) -> str:
    return "+".join(f"cast({rows}>{1024 * 16**digit} as bigint)" for digit in range(MOST_DIGITS))


def _tree(table: str) -> str:
    view = VIEW_OF_TABLE[table]
    covering = "sha256(string_agg({0}, ',' order by {0})) as digest"
    steps = [
        f"hashed as (select sha256({_json(SCHEMAS[table].names)}) as h from {view})",
        f"size as (select {_digits('count(*)')} as depth from hashed)",
        "copies as (select left(h, depth) as node, concat(h, ':', count(*)) as member, count(*) as n"
        " from hashed, size group by h, depth)",
        f"leaves as (select node, cast(sum(n) as bigint) as rows, {covering.format('member')}"
        " from copies group by node)",
        f"level{MOST_DIGITS} as (select * from leaves where length(node)={MOST_DIGITS})",
    ]
    for level in reversed(range(MOST_DIGITS)):
        member = "concat(node, ':', rows, ':', digest)"
        steps.append(
            f"level{level} as (select * from leaves where length(node)={level} union all"
            f" select left(node, {level}), cast(sum(rows) as bigint), {covering.format(member)}"
            f" from level{level + 1} group by left(node, {level}))"
        )
    nodes = " union all ".join(f"select * from level{level}" for level in range(MOST_DIGITS + 1))
    return f"(with {', '.join(steps)} select '{table}' as table_name, node, rows, digest from ({nodes}))"


_MENDED = {"total_cents": "subtotal_cents+tax_cents-discount_cents", "currency": "'INR'"}


VIEWS["v_fingerprints"] = " union all ".join(_fingerprint(table) for table in TABLES)

# --- the six synthetic tables -------------------------------------------------------------------------

VIEWS["s_t_orders"] = (
    "select concat('o-', lpad(cast(i as varchar),"
    " cast(greatest(8, length(cast(i as varchar))) as integer), '0')) as order_id,"
    " concat('c-', lpad(cast(i%greatest(5, n//5) as varchar),"
    " cast(greatest(5, length(cast(i%greatest(5, n//5) as varchar))) as integer), '0')) as customer_id,"
    " concat('s-', lpad(cast(i%3+1 as varchar), 2, '0')) as store_id,"
    " 1700000000+i*10 as order_ts, 'COMPLETED' as status, sub as subtotal_cents, tax as tax_cents,"
    " cast(discount as bigint) as discount_cents, sub+tax-discount as total_cents, 'INR' as currency"
    " from s_full, s_count"
)
VIEWS["s_t_movements"] = (
    "select concat_ws('-', 'opening', product_id, store_id) as movement_id, product_id, store_id,"
    " (select greatest(100, n*4) from s_count) as quantity_delta, 'OPENING' as reason,"
    " cast(1699999999 as bigint) as movement_ts from"
    " (select concat('p-', lpad(cast(number as varchar), 3, '0')) as product_id,"
    " concat('s-', lpad(cast(store as varchar), 2, '0')) as store_id from range(1, 21) as p(number), range(1, 4) as t(store)) union all"
    " select concat('sale-', order_id, '-l-', cast(step+1 as varchar)), product_id, store_id,"
    " -quantity, 'SALE', 1700000000+i*10 from s_lines union all"
    " select concat('return-', order_id, '-l-', cast(step+1 as varchar)), product_id, store_id,"
    " cast(1 as bigint), 'RETURN', 1700000000+i*10+5 from s_lines where i%17=0 and step=0"
)
VIEWS["s_t_lines"] = (
    "select order_id, concat('l-', cast(step+1 as varchar)) as line_id, product_id, quantity,"
    " price as unit_price_cents, quantity*price as line_total_cents from s_lines"
)
VIEWS["s_t_payments"] = (
    "select concat('pay-', substr(order_id, 3)) as payment_id, order_id, total_cents as amount_cents,"
    " 'CAPTURED' as status from s_t_orders"
)
VIEWS["s_t_returns"] = (
    "select concat('ret-', substr(order_id, 3)) as return_id, order_id, 'l-1' as line_id,"
    " cast(1 as bigint) as quantity, price as refund_cents from s_lines where i%17=0 and step=0"
)
VIEWS["s_t_products"] = (
    "select concat('p-', lpad(cast(number as varchar), 3, '0')) as product_id,"
    f" list_extract({list(CATEGORIES)}, number%3+1) as category,"
    f" cast({START_TS - DAY} as bigint) as effective_from, cast(null as bigint) as effective_to,"
    f" cast({START_TS - HOUR} as bigint) as loaded_at from range(1, {PRODUCTS + 1}) as p(number)"
)
SYNTHETIC_VIEWS = {
    table: f"s_t_{'lines' if table == 'order_lines' else table.split('_')[-1]}" for table in TABLES
}

# --- queries -----------------------------------------------------------------------------------------

GENERATION = "g-star-0123456789ab"


def _counts(sources: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as rows from {view}" for name, view in sources.items()
    )


def _metric(name: str, value: str, source: str) -> str:
    return f"select '{name}' as metric, cast(coalesce({value}, 0) as bigint) as value from {source}"


VIEWS["v_metrics"] = " union all ".join(
    [
        *[_metric(table, "count(*)", VIEW_OF_TABLE[table]) for table in TABLES],
        _metric("gross_order_cents", "sum(total_cents)", "f_orders"),
        _metric("captured_cents", "sum(amount_cents)", "f_payments where status='CAPTURED'"),
        _metric("refunded_cents", "sum(refund_cents)", "v_valid_returns"),
    ]
)

_DIGEST_OBJECT = (
    "{{'bucket': 'landing', 'etag': md5(accepted_digest), "
    "'key': concat('{name}/', cast(batch_id as varchar)), 'sha256': sha256(accepted_digest), "
    "'size_bytes': registered_seq*10+1, 'version_id': accepted_version_id}}"
)
_DIGEST_TABLES = ", ".join(
    f"'{name}': {{'objects': [{_DIGEST_OBJECT.format(name=name)}], "
    f"'rows': registered_seq+{TABLES.index(name)}, 'sha256': sha256(concat('{name}', accepted_digest))}}"
    for name in sorted(TABLES)
)
_KINDS = [*list(EXPECTED_OUTCOMES)[:6], "other"]

BODIES: dict[str, str] = {
    **{f"gate_{code.lower()}": sql for code, sql in GATE_SQL.items()},
    "violation_report": "select * from v_report",
    "violation_summary": "select code, count(*) as violations from v_report group by code",
    "violated_codes": "select coalesce(string_agg(code, ',' order by code), '') as codes"
    " from (select distinct code from v_report)",
    "sorted_duplicates": GATE_SQL["DUPLICATE_ID"],
    "is_violated": " union all ".join(
        f"select '{code}' as code, count(*)>0 as violated from v_report where code='{code}'"
        for code in GATE_SQL
    ),
    "probe_limit": "select count(*)>0 as has_duplicates from"
    " (select order_id from f_orders group by order_id having count(*)>1)",
    "valid_returns": "select * from v_valid_returns",
    "line_events": "select * from v_events",
    "temporal_match": "select * exclude (matched) from v_matches",
    "resolve_product": "select order_id, line_id, product_id, order_ts,"
    " case when n=1 then category end as category,"
    " case when n=1 then effective_from end as effective_from,"
    " case when n=1 then effective_to end as effective_to,"
    " case when n=1 then loaded_at end as loaded_at from v_counts",
    "dimension_match_count": "select order_id, line_id, n as dimension_matches from v_counts",
    "resolved_sales": "select c.category, count(*) as lines, cast(sum(l.quantity) as bigint) as quantity,"
    " cast(sum(l.line_total_cents) as bigint) as revenue_cents from"
    " (select order_id, line_id, product_id, sum(quantity) as quantity,"
    " sum(line_total_cents) as line_total_cents from f_lines group by all) l"
    " join v_counts c on l.order_id=c.order_id and l.line_id=c.line_id and l.product_id=c.product_id"
    " where c.n=1 group by c.category",
    "line_totals": "select order_id, cast(sum(line_total_cents) as bigint) as line_subtotal"
    " from f_lines group by order_id",
    "captured_by_order": "select * from v_captured",
    "refunds_by_order": "select order_id, cast(sum(refund_cents) as bigint) as refund_cents"
    " from v_valid_returns group by order_id",
    "returned_by_line": "select order_id, line_id, cast(sum(quantity) as bigint) as returned_quantity"
    " from v_valid_returns group by order_id, line_id",
    "batch_metrics": "select * from v_metrics",
    "running_stock": "select * from v_stock",
    "status_filter": "select 'order' as kind, order_id as id, status from f_orders"
    " where status='COMPLETED' union all"
    " select 'payment', payment_id, status from f_payments where status='CAPTURED'",
    "entity_key": "select concat_ws(':', order_id, line_id) as entity_id from f_lines union all"
    " select concat_ws(':', product_id, store_id) from f_movements",
    "tag_generation": " union all ".join(
        f"select '{table}' as table_name, {_json([*SCHEMAS[table].names, 'generation_id'])} as json"
        f" from (select *, '{GENERATION}' as generation_id from {view})"
        for table, view in VIEW_OF_TABLE.items()
    ),
    "business_result": "select count(*) as orders, cast(sum(total_cents) as bigint) as gross_cents"
    " from f_orders",
    "six_table_counts": "select "
    + ", ".join(f"(select count(*) from {VIEW_OF_TABLE[table]}) as {table}" for table in TABLES),
    "result_reconciliation": "select coalesce(e.metric, a.metric) as metric, e.value as expected,"
    " a.value as actual, coalesce(e.value=a.value, false) as passed from ("
    + " union all ".join(
        [
            _metric("orders", "count(*)", "r_orders"),
            _metric("order_lines", "count(*)", "r_lines"),
            _metric("parts", "count(*)", "part"),
            _metric(
                "gross_order_cents", "sum(subtotal_cents+tax_cents-discount_cents)", "r_orders"
            ),
        ]
    )
    + ") e full join v_metrics a on e.metric=a.metric",
    "row_count_proof": "select d.table_name, d.rows as declared_rows, a.rows as actual_rows from ("
    + _counts(VIEW_OF_TABLE | {"orders": "r_orders", "order_lines": "r_lines", "payments": "r_orders"})
    + ") d join ("
    + _counts(VIEW_OF_TABLE)
    + ") a on d.table_name=a.table_name where d.rows<>a.rows",
    "manifest_table_set": "select cast(product_id as varchar) as table_name, 'actual' as missing_from"
    " from (select product_id from f_lines except select product_id from f_products) union all"
    " select cast(product_id as varchar), 'declared'"
    " from (select product_id from f_products except select product_id from f_lines)",
    "table_set_difference": "select cast(order_id as varchar) as table_name, 'left' as only_in"
    " from (select order_id from f_orders except select order_id from f_payments) union all"
    " select cast(order_id as varchar), 'right'"
    " from (select order_id from f_payments except select order_id from f_orders)",
    "table_fingerprint": "select * from v_fingerprints",
    "digest_tree": " union all ".join(f"select * from {_tree(table)}" for table in TABLES),
    "changed_rows": f"with size as (select {_digits('count(*)')} as depth from f_orders),"
    f" held as (select {_json(SCHEMAS['orders'].names, _MENDED)} as row, 1 as was, 0 as now from f_orders"
    f" union all select {_json(SCHEMAS['orders'].names)}, 0, 1 from f_orders)"
    " select left(sha256(row), depth) as node, row, cast(sum(was) as bigint) as copies_before,"
    " cast(sum(now) as bigint) as copies_after from held, size group by row, depth"
    " having sum(was)<>sum(now)",
    "object_proof": "select coalesce(d.bucket, s.bucket) as bucket, coalesce(d.key, s.key) as key,"
    " coalesce(d.version_id, s.version_id) as version_id,"
    " case when s.version_id is null then 'MISSING_OBJECT'"
    " when d.version_id is null then 'UNDECLARED_OBJECT'"
    " when d.size_bytes<>s.size_bytes then 'SIZE' when d.sha256<>s.sha256 then 'SHA256'"
    " else 'ETAG' end as reason from p_declared d full join p_stored s"
    " on d.bucket=s.bucket and d.key=s.key and d.version_id=s.version_id"
    " where s.version_id is null or d.version_id is null or d.size_bytes<>s.size_bytes"
    " or d.sha256<>s.sha256 or d.etag<>s.etag",
    "object_evidence_valid": "select page_id, bucket<>'' and key<>'' and page_id%5<>0"
    " and page_id%7<>0 and size_bytes>=1 and page_id%11<>0 as valid from p_objects",
    "file_inventory": "select concat(source, '/', lpad(cast(doc_id as varchar), 12, '0')) as path,"
    " cast(octet_length(encode(text)) as bigint) as size_bytes, sha256(text) as sha256 from documents",
    "canonical_row_json": f"select {_json(SCHEMAS['products'].names)} as json from f_products"
    f" union all select {_json(['doc_id', 'text', 'lang', 'source'])} from documents",
    "sha256_hex": "select doc_id, sha256(text) as sha256 from documents",
    "generation_id": f"select page_id, {_generation('url', 'sha256(html)')} as id from pages",
    "contract_regex": "select page_id,"
    " regexp_full_match(bucket, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') as host_is_batch,"
    " regexp_full_match(url, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') as url_is_batch,"
    " regexp_full_match(sha256(html), '[a-f0-9]{64}') as sha_is_digest,"
    " regexp_full_match(md5(html), '[a-f0-9]{64}') as md5_is_digest,"
    " regexp_full_match(sha256(html)||chr(10), '[a-f0-9]{64}') as newline_is_digest,"
    f" regexp_full_match({_generation('url', 'sha256(html)')}, 'g-[A-Za-z0-9_-]+-[a-f0-9]{{12}}')"
    " as generation_ok,"
    " regexp_full_match('db_'||split_part(url, '/', 4), '[A-Za-z_][A-Za-z0-9_]*') as database_ok"
    " from pages join p_objects using (page_id)",
    "null_to_zero": "select product_id, effective_from, coalesce(effective_to, 0) as effective_to"
    " from f_products",
    "valid_at": "select product_id, effective_from, effective_to, "
    + ", ".join(
        f"effective_from<={moment} and (effective_to is null or {moment}<effective_to) as {name}"
        for name, moment in {
            "before": 699999999,
            "at_start": 700000000,
            "before_end": 879999999,
            "at_end": 880000000,
        }.items()
    )
    + " from f_products",
    "uri_parts": f"select page_id, nullif(regexp_extract(url, {_URL}, 1), '') as scheme,"
    f" case when regexp_matches(url, {_URL}) then regexp_extract(url, {_URL}, 2) end as bucket,"
    f" case when regexp_matches(url, {_URL}) then ltrim(regexp_extract(url, {_URL}, 3), '/') end as key,"
    " true as is_rejected from pages",
    "checksum_hex": "select doc_id, sha256(text) as sha256 from documents",
    "etag_normalize": "select doc_id, md5(text) as etag from documents",
    "tax_cents": "select order_id, subtotal_cents, subtotal_cents*18//100 as tax_cents from r_orders",
    "truncate_text": "select doc_id, substr(text, 1, 64) as failure_stage,"
    " substr(text, 1, 512) as failure_code from documents",
    "run_prefix": "select doc_id, split_part(concat_ws('-', source, lang, text), '-', 1) as kind"
    " from documents",
    "manifest_digest": "select cast(batch_id as varchar) as batch_id, sha256(cast(to_json({"
    "'as_of_knowledge_time': 996000000, 'batch_id': cast(batch_id as varchar),"
    " 'contract_version': 'retail-v2', 'produced_at': registered_seq,"
    f" 'tables': {{{_DIGEST_TABLES}}}}}) as varchar)) as digest from v_registry",
    "registry": "select * from v_registry",
    "accepted_identity": "select batch_id, accepted_digest from v_registry",
    "identity_conflicts": "select batch_id, seq, case when manifest_digest<>accepted_digest"
    " then 'CONTENT' else 'LOCATION' end as conflict from v_later"
    " where manifest_digest<>accepted_digest or manifest_version_id<>accepted_version_id",
    "replay_classification": "select l.batch_id, l.seq, case o.before when 'PUBLISHED' then 'REPLAYED'"
    " when 'FAILED' then 'RECOVERING' else 'IN_PROGRESS' end as classification"
    " from v_later l join v_outcomes o on l.batch_id=o.batch_id and l.seq=o.seq"
    " where manifest_digest=accepted_digest and manifest_version_id=accepted_version_id",
    "lifecycle_state": "select batch_id, arg_max(after, seq) as state,"
    " max(case when accepted then seq end) as last_accepted_seq from v_outcomes group by batch_id",
    "illegal_transitions": "select batch_id, seq, action, before as state_before,"
    " case when before='UNREGISTERED' then 'UNKNOWN_GENERATION' when action='publish'"
    " then 'NOT_VALIDATED' else 'ILLEGAL_TRANSITION' end as reason"
    " from v_outcomes where not accepted and action<>'register'",
    "build_attempts": "select batch_id, cast(sum(case when accepted and action='start_build'"
    " then 1 else 0 end) as bigint) as attempts from v_outcomes group by batch_id",
    "pointer_cas": "select pointer_id, batch_id, seq, expected as expected_pointer_version,"
    " case when hit then 'PUBLISHED' else 'STALE_PUBLISHER' end as outcome,"
    " case when hit then expected+1 end as pointer_version from v_cas",
    "resolve_active": "select a.pointer_id, a.batch_id, a.pointer_version, case when s.state='PUBLISHED'"
    " then 'RESOLVED' else 'ACTIVE_POINTER_INVALID' end as status"
    " from v_active a left join v_state s on a.batch_id=s.batch_id",
    "retained_generations": "select c.pointer_id, c.batch_id, max(c.version) as pointer_version"
    " from v_cas c join v_active a on c.pointer_id=a.pointer_id"
    " where c.hit and c.batch_id<>a.batch_id group by c.pointer_id, c.batch_id",
    "evidence_complete": "with e as (select event_id, place,"
    " event_id%11<>0 as digest_ok,"
    " not (event_id%19=0 and place=1) and event_id>0 and not (event_id%23=0 and place=2) as snapshot_ok"
    " from (select event_id, unnest(range(6)) as place from events where event_type='click')"
    " where not (event_id%7=0 and place=5)),"
    " g as (select event_id, bool_and(digest_ok) as d, bool_and(snapshot_ok) as s, count(*)=6 as t"
    " from e group by event_id)"
    " select concat('g-', cast(k.event_id as varchar)) as generation_id,"
    " coalesce(d, false) as manifest_matches, coalesce(t, false) as tables_complete,"
    " coalesce(s, false) as snapshots_valid, coalesce(d and t and s, false) as complete"
    " from events k left join g on k.event_id=g.event_id where k.event_type in ('click','view')",
    "latest_snapshot": "select seq as snapshot_id, ts as committed_at from f_log"
    " order by ts desc, seq desc limit 1",
    "outcome_reconciliation": "with x(kind, expected) as (values "
    + ", ".join(f"('{kind}','{status}')" for kind, status in EXPECTED_OUTCOMES.items())
    + "), r as (select list_extract(["
    + ", ".join(f"'{kind}'" for kind in _KINDS)
    + "], event_id%7+1) as kind, case when event_type='error' then 'FAILED' else 'SUCCEEDED' end"
    " as status, event_id from events),"
    " a as (select kind, arg_max(status, event_id) as actual from r group by kind)"
    " select x.kind, x.expected, a.actual, coalesce(x.expected=a.actual, false) as passed"
    " from x left join a on x.kind=a.kind",
    "usage_metering": "with j as (select count(*) as job_runs, coalesce(sum(case when event_id%3<>0"
    " then cast(event_id%500 as double) else cast(event_id%300 as double)"
    " * case when event_id%5<>0 then event_id%2+2 else 2 end end), 0) as dpu"
    " from events where event_type='purchase'),"
    " b as (select case when event_id%4=0 then 0 else event_id*1000%50000000 end as bytes"
    " from events where event_type='view'),"
    " s as (select cast(coalesce(sum(bytes),0) as bigint) as bytes_scanned,"
    " count(case when bytes>0 then 1 end) as scans,"
    " cast(coalesce(sum(case when bytes>0 then greatest(bytes, 10485760) end),0) as bigint)"
    " as billable_bytes from b)"
    " select job_runs, round(dpu, 3) as dpu_seconds, bytes_scanned, scans, billable_bytes,"
    " round(dpu/3600*cast(0.44 as double), 6) as compute_usd,"
    " round(billable_bytes/cast(1000000000000 as double)*cast(5.0 as double), 6) as scan_usd,"
    " round(dpu/3600*cast(0.44 as double)"
    "+billable_bytes/cast(1000000000000 as double)*cast(5.0 as double), 6) as total_usd from j, s",
    "write_batch_table": " union all ".join(
        f"select '{table}' as table_name, {_json(SCHEMAS[table].names)} as line from {view}"
        for table, view in VIEW_OF_TABLE.items()
    ),
    "read_batch_table": " union all ".join(
        f"select '{table}' as table_name, {_json(SCHEMAS[table].names)} as json from {view}"
        for table, view in VIEW_OF_TABLE.items()
    ),
    "generation_sink": " union all ".join(
        f"select '{table}' as table_name, {_json([*SCHEMAS[table].names, 'generation_id'])} as json"
        f" from (select *, '{GENERATION}' as generation_id from {view}"
        + (" where status='CAPTURED')" if table == "payments" else ")")
        for table, view in VIEW_OF_TABLE.items()
    ),
    "generation_evidence": f"select '{GENERATION}' as generation_id, * from v_fingerprints",
    "pinned_read": " union all ".join(
        f"select '{table}' as table_name, {_json([*SCHEMAS[table].names, 'generation_id'])} as json"
        f" from (select *, '{GENERATION}' as generation_id from {view})"
        for table, view in VIEW_OF_TABLE.items()
    ),
    "read_manifest": "select 'star' as batch_id, * from v_fingerprints",
    "synthetic_batch": " union all ".join(
        f"select '{table}' as table_name, {_json(SCHEMAS[table].names)} as json from {view}"
        for table, view in SYNTHETIC_VIEWS.items()
    ),
    "build_publish_serve": "select *, cast(1 as bigint) as pointer_version, 'replayed' as second_build,"
    " true as is_verified from ("
    + " union all ".join(_fingerprint(table, view) for table, view in SYNTHETIC_VIEWS.items())
    + ")",
    "synthetic_movements": "select * from s_t_movements",
    "expected_results": "select count(*) as orders, cast(sum(sub+tax-discount) as bigint) as gross_cents"
    " from s_full",
    "inject_fault": "select order_id, total_cents + case when order_id=(select min(order_id) from f_orders)"
    " then 1 else 0 end as total_cents from f_orders",
}

for _name in ("running_stock", "resolve_product", "gate_orphan_line", "lifecycle_state", "pointer_cas"):
    BODIES[f"split_{_name}"] = BODIES[_name]
_orphans = BODIES["gate_orphan_payment"]
BODIES["split_gate_orphan_payment"] = (
    f"select * from ({_orphans}) union all select o.* from ({_orphans}) o, range(50)"
    " where cast(entity_id as bigint) in (select payment_id from f_payments where order_id%97=5)"
)


def _with_views(body: str, views_by_name: dict[str, str] = VIEWS) -> str:
    """The body preceded by the views it names, directly or through other views."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\b[a-z]_[a-z_]+\b", pending.pop()))
        for name in words & views_by_name.keys() - needed:
            needed.add(name)
            pending.append(views_by_name[name])
    # A view may only name views above it, so emit them by dependency.
    placed: list[str] = []

    def place(name: str) -> None:
        if name not in placed:
            for other in set(re.findall(r"\b[a-z]_[a-z_]+\b", views_by_name[name])) & views_by_name.keys() - {name}:
                place(other)
            placed.append(name)

    for name in sorted(needed):
        place(name)
    if not placed:
        return body
    views = ",\n".join(f"{name} as ({views_by_name[name].strip()}\n)" for name in placed)
    if body.startswith("with "):
        return f"with {views},\n{body[5:]}"
    return f"with {views}\n{body}"


ORACLES: dict[str, str] = {name: _with_views(body) for name, body in BODIES.items()}

# The batch without its own overlapping versions and uncovered refunds, which hide an injected one.
MENDED_VIEWS = {
    "s_returns": f"select * from ({VIEWS['f_returns']}) where refund_cents<100000000000"
    " and order_id in (select order_id from f_payments where status='CAPTURED')",
    "s_products": f"select * from ({VIEWS['f_products']}) where category not in ('overlap', 'dup')",
}

# One faulted view each; the row at fault is the one with the least key.
_ORDER = "(select * from f_orders order by order_id limit 1)"
_LINE = f"{_ORDER} o join f_lines l on l.order_id=o.order_id order by l.order_id, l.line_id limit 1"
FAULTED_VIEWS = {
    "broken_total": (
        "ORDER_TOTAL",
        "f_orders",
        "select * replace (total_cents + case when order_id=(select min(order_id) from f_orders)"
        " then 1 else 0 end as total_cents) from f_orders",
    ),
    "excess_refund": (
        "EXCESS_REFUND",
        "f_returns",
        "select * from f_returns union all (select cast(-1 as bigint), l.order_id, l.line_id,"
        f" cast(1 as bigint), o.total_cents+1 from {_LINE})",
    ),
    "missing_product": (
        "MISSING_DIMENSION",
        "f_products",
        "select * from f_products where product_id <>"
        " (select product_id from f_lines order by order_id, line_id limit 1)",
    ),
    "overlapping_version": (
        "AMBIGUOUS_DIMENSION",
        "f_products",
        "select * from f_products union all (select product_id, 'overlapping-version', effective_from+1,"
        " effective_to, loaded_at+1 from f_products order by product_id, effective_from, loaded_at limit 1)",
    ),
    "negative_stock": (
        "NEGATIVE_INVENTORY",
        "f_movements",
        "select * from f_movements union all (select cast(0 as bigint), l.product_id, o.store_id,"
        f" cast(-1000000 as bigint), 'CORRUPTION', o.order_ts+1 from {_LINE})",
    ),
}


def _under_fault(fault: str) -> str:
    code, view, changed = FAULTED_VIEWS[fault]
    sound = f"s{view[1:]}"
    others = {name: MENDED_VIEWS[f"s{name[1:]}"] for name in ("f_returns", "f_products")}
    held = {**VIEWS, **others}
    views = {**held, sound: held[view], view: re.sub(rf"\b{view}\b", sound, changed)}
    body = _with_views(BODIES[f"gate_{code.lower()}"], views)
    return f"select '{fault}' as fault, code, entity_id, message from ({body})"


ORACLES["fault_codes"] = "\nunion all\n".join(map(_under_fault, FAULTED_VIEWS))
