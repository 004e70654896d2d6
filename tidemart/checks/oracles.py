"""The SQL every query must agree with, written for DuckDB and kept unlike the Spark plans."""

from __future__ import annotations

_ITEMS = """
oi as (
  select l_orderkey*10+l_linenumber as id, l_orderkey as order_id, o_custkey as user_id, l_partkey as product_id,
         l_suppkey as inventory_item_id, l_linestatus as status, o_orderdate as created_at, l_shipdate as updated_at,
         l_shipdate - interval 5 day as shipped_at,
         case when l_returnflag='R' then l_shipdate - interval 3 day
              when l_returnflag='A' then l_shipdate
              when l_linestatus='F' then l_shipdate - interval 1 day end as delivered_at,
         case when l_returnflag='R' then l_shipdate end as returned_at,
         l_extendedprice as sale_price
  from lineitem join orders on l_orderkey = o_orderkey
)"""
_PRODUCTS = """
pd as (
  select p_partkey as id, concat('Brand#', cast((p_partkey+k)%25 as varchar(10))) as brand,
         case when p_size%2=0 then 'Men' else 'Women' end as department, p_type as category,
         timestamp '1995-01-01 00:00:00' + ((p_partkey*37 + (k%4)*421) % 2400) * interval 1 day
           + (case when k=4 then 6 else 0 end) * interval 1 hour as updated_at
  from part cross join (values (0),(1),(2),(3),(4)) v(k)
)"""
_ORDER = """order by updated_at desc nulls last, order_id, user_id, product_id, inventory_item_id, status,
            created_at, shipped_at, delivered_at, returned_at, sale_price"""
_FACT = f"""{_ITEMS},
fact as (
  select * from oi qualify row_number() over (partition by id, cast(updated_at as date) {_ORDER}) = 1
)"""
_DIM = f"""{_PRODUCTS},
dim as (
  select p.* from pd p
  where not exists (select 1 from pd q where q.id = p.id and cast(q.updated_at as date) = cast(p.updated_at as date)
                                         and q.updated_at > p.updated_at)
)"""
_SALES = f"""{_FACT}, {_DIM},
sales as (
  select * from fact
  where delivered_at is not null
    and (date_trunc('day', delivered_at) = date_trunc('day', updated_at)
         or date_trunc('day', returned_at) = date_trunc('day', updated_at))
),
matched as (
  select s.id, s.product_id, s.created_at, s.updated_at, s.sale_price, s.returned_at,
         d.updated_at as version_at, d.category, d.brand, d.department
  from sales s asof left join dim d on s.product_id = d.id and s.created_at >= d.updated_at
)"""
_TOTAL = """cast(sum(case when returned_at is not null then -cast(sale_price as decimal(18,4))
                          else cast(sale_price as decimal(18,4)) end) as double) as total_sales"""
_REPORT = f"""select cast(updated_at as date) as sales_date, category, brand, department, {_TOTAL}
from {{}} group by all"""
_TWO_DAYS = "cast(updated_at as date) between date '1998-06-15' and date '1998-06-16'"
_IN_HOURS = """(date_trunc('hour', ts) in (timestamp '2024-01-02 05:00:00', timestamp '2024-01-02 06:00:00',
                                        timestamp '2024-01-17 23:00:00'))"""
_MERGE = """
select * from m where not exists (select 1 from d where d.id = m.id and m.updated_at <= d.updated_at)
union all
select * from d where not exists (select 1 from m where m.id = d.id and not coalesce(m.updated_at <= d.updated_at, false))
"""
_HALVES = f"""{_ITEMS},
older as (select * from oi where updated_at < timestamp '1996-01-01'
          qualify row_number() over (partition by id {_ORDER}) = 1),
newer as (select * from oi where updated_at >= timestamp '1996-01-01'
          qualify row_number() over (partition by id {_ORDER}) = 1)"""
_LAST_EVENT = "select e.* from events e join (select user_id, max(ts) as ts from events group by user_id) using (user_id, ts)"


def _census(name: str, table: str, key: str, audit: str) -> str:
    return (
        f"select '{name}' as table_name, count(*) as n_rows, count(distinct {key}) as n_keys, "
        f"max({audit}) as last_audit from {table}"
    )


_ASOF = f"""
    with {_FACT}, {_DIM}
    select s.id, s.product_id, s.created_at, s.updated_at, d.updated_at as version_at, d.brand, d.department, d.category
    from fact s asof left join dim d on s.product_id = d.id and s.created_at >= d.updated_at"""

def _fanout(table: str, key: str, audit: str) -> str:
    return f"""
        select '{table}' as table_name,
               count(*) + count(*) filter (where date_trunc('hour', {audit}) = timestamp '1996-01-02 00:00:00') as n_rows,
               count(distinct {key}) as n_keys, max({audit}) as last_audit
        from {table}"""


ORACLES: dict[str, str] = {
    "snapshot_scan": "select * from orders",
    "hourly_window_extract": "select * from events where date_trunc('hour', ts) = timestamp '2024-01-02 05:00:00'",
    "hourly_window_extract_dates": """
        select *, cast(ts as date) as day, 0 as hour from events
        where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-03'""",
    "slice_path_labels": """
        select strftime(date_trunc('hour', ts), '%Y-%m-%d/%H-%M-%S') as hour_path,
               date_trunc('hour', ts) + interval 1 hour as hour_end,
               strftime(date_trunc('day', ts) - interval 1 day, '%Y-%m-%d') as previous_day,
               count(*) as n
        from events group by all""",
    "slice_resolution": f"""
        with {_ITEMS},
        ways(way, lo, hi) as (values
            ('full_refresh', timestamp '1995-01-01', timestamp '9999-01-01'),
            ('explicit_date', timestamp '1998-06-16', timestamp '1998-06-17'),
            ('explicit_first_run', timestamp '1998-05-02', timestamp '1998-05-03'),
            ('yesterday', timestamp '1998-06-19', timestamp '1998-06-20'))
        select way, count(*) as n, min(cast(updated_at as date)) as first_day, max(cast(updated_at as date)) as last_day
        from oi join ways on updated_at >= lo and updated_at < hi group by way""",
    "day_slice": "select * from events where cast(ts as date) = date '2024-01-02'",
    "since_slice": f"with {_ITEMS} select * from oi where cast(updated_at as date) >= date '1996-01-01'",
    "landing_roundtrip": "select * from events",
    "landing_roundtrip_texts": "select * from documents",
    "delta_append_replay": """
        select * from events union all
        select * from events where ts >= timestamp '2024-01-02 05:00:00' and ts < timestamp '2024-01-02 06:00:00'""",
    "delta_append_plain": "select * from orders union all select * from orders",
    "snapshot_to_delta": "select * from orders",
    "hourly_cdc_cycle": f"select * from events union all select * from events where {_IN_HOURS}",
    "registry_fanout": "with "
    + _ITEMS
    + ", "
    + _PRODUCTS
    + "\n"
    + "\nunion all\n".join(
        [
            _census("orders", "orders", "o_orderkey", "o_orderdate"),
            _census("lineitem", "lineitem", "(l_orderkey, l_linenumber)", "l_shipdate"),
            _census("events", "events", "event_id", "ts"),
            _census("feed", "events", "user_id", "ts"),
            _census("order_items", "oi", "id", "updated_at"),
            _census("products", "pd", "id", "updated_at"),
        ]
    ),
    "hourly_cdc_fanout": "\nunion all\n".join(
        [
            _fanout("orders", "o_orderkey", "o_orderdate"),
            _fanout("lineitem", "(l_orderkey, l_linenumber)", "l_shipdate"),
            _fanout("events", "event_id", "ts"),
        ]
    ),
    "latest_per_key": _LAST_EVENT,
    "latest_per_key_items": """
        select * from lineitem qualify row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_shipdate desc nulls last, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus) = 1""",
    "latest_per_key_per_day": """
        select e.* from events e
        join (select user_id, max(ts) as ts from events group by user_id, cast(ts as date)) using (user_id, ts)""",
    "merge_upsert": f"with {_HALVES}, m as (select * from older), d as (select * from newer) {_MERGE}",
    "merge_stale_guard": f"with {_HALVES}, m as (select * from newer), d as (select * from older) {_MERGE}",
    "main_bootstrap": _LAST_EVENT,
    "daily_merge": _LAST_EVENT,
    "order_items_fact_full": f"with {_FACT} select * from fact",
    "order_items_fact_day": f"with {_FACT} select * from fact where cast(updated_at as date) = date '1998-06-16'",
    "product_dimension_full": f"with {_DIM} select * from dim",
    "product_dimension_day": f"with {_DIM} select * from dim where cast(updated_at as date) = date '1998-05-02'",
    "overwrite_partitions": """
        select event_id, ts, user_id, event_type,
               case when ts >= timestamp '2024-01-16' then value * 2 else value end as value, props from events""",
    "qualifying_sales": f"with {_SALES} select * from sales",
    "asof_left_join": _ASOF,
    "asof_left_join_slots": _ASOF,
    "asof_left_join_dense": """
        with seen as (select user_id, ts as seen_at, event_type as seen_type from events where event_type <> 'purchase')
        select b.event_id, b.user_id, b.ts, b.value, s.seen_at, s.seen_type
        from (select * from events where event_type = 'purchase') b
        asof left join seen s on b.user_id = s.user_id and b.ts >= s.seen_at""",
    "signed_sales_exact": f"""
        with {_FACT} select status, cast(sum(case when returned_at is not null then -price else price end) as decimal(38,5)) as total_sales
        from (select *, cast(cast(round(sale_price * 100) as bigint) * 125 as decimal(18,0)) * cast(0.00001 as decimal(5,5)) as price from fact)
        group by status""",
    "latest_per_key_reserved": f"select *, event_id % 7 as _rank, user_id * 2 as place from ({_LAST_EVENT})",
    "signed_sales_by_status": f"with {_FACT} select status, {_TOTAL} from fact group by status",
    "sales_with_product_version": f"with {_SALES} select * from matched",
    "sales_report_full": f"with {_SALES} {_REPORT.format('matched')}",
    "sales_report_day": f"with {_SALES} "
    + _REPORT.format("(select * from matched where cast(updated_at as date) = date '1998-06-16')"),
    "sales_report_per_item": f"""
        with {_FACT}, {_DIM},
        ranked as (
          select s.updated_at, s.sale_price, s.returned_at, d.category, d.brand, d.department,
                 row_number() over (partition by s.id order by d.updated_at desc nulls last, s.updated_at desc) as pick
          from fact s left join dim d on s.product_id = d.id and s.created_at >= d.updated_at
          where s.delivered_at is not null
            and (cast(s.delivered_at as date) = cast(s.updated_at as date)
                 or cast(s.returned_at as date) = cast(s.updated_at as date))
        )
        {_REPORT.format("(select * from ranked where pick = 1)")}""",
    "gold_refresh": f"with {_SALES} {_REPORT.format('matched')}",
    "gold_late_slice": f"with {_SALES} {_REPORT.format('matched')}",
    "gold_of_yesterday": "with "
    + _SALES.replace("join dim d", f"join (select * from dim where {_TWO_DAYS}) d")
    + _REPORT.format(f"(select * from matched where {_TWO_DAYS})"),
    "layer_views": f"""
        select l.*, n_logged from ({_LAST_EVENT}) l
        join (select user_id, count(*) as n_logged from events group by user_id) using (user_id)""",
    "merge_folded": """
        select e.* from events e
        join (select user_id, max(ts) as ts from events where ts < timestamp '2024-01-31' group by user_id) using (user_id, ts)""",
    "landing_stream": "select * from events",
    "landing_stream_late": "select * from events",
    "landing_stream_replay": "select * from events",
    "stream_upsert_late": _LAST_EVENT,
    "daily_merge_out_of_order": """
        with older as (select arg_max(e, ts) as e, user_id from (select user_id, ts, events as e from events)
                       where ts < timestamp '2024-01-28' group by user_id),
             newer as (select user_id, cast(ts as date) as day, max(ts) as ts from events
                       where ts >= timestamp '2024-01-28' and ts < timestamp '2024-01-31' group by all),
             merged as (select user_id, ts from newer qualify row_number() over (partition by user_id order by ts desc) = 1)
        select e.* from events e join merged using (user_id, ts)
        union all
        select unnest(e) from older where user_id not in (select user_id from merged)""",
    "stream_upsert": _LAST_EVENT,
}
