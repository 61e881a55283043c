"""The same results in SQL, written without the operators, for DuckDB."""

from __future__ import annotations

SHIPMENTS_INNER = """
select l_orderkey as order_id, l_returnflag as ship_flag, l_linestatus as ship_status,
       l_partkey as product, l_quantity as qty, l_extendedprice as price
from lineitem where l_returnflag in ('N', 'R')
union all
select l_orderkey, l_returnflag, l_linestatus, l_partkey, -l_quantity, -l_extendedprice
from lineitem where l_returnflag = 'R'
"""
SHIPMENTS_OUTER = (
    SHIPMENTS_INNER
    + """
union all
select l_orderkey, l_returnflag, l_linestatus, null, null, null
from lineitem where l_returnflag not in ('N', 'R')
"""
)

CUSTOMER_CASE = """
with target as (
  select c_custkey as id, c_name as name, c_mktsegment as city, date '2023-01-01' as eff_start,
         case when c_acctbal >= 0 then date '9999-12-31' else date '2023-08-19' end as eff_end,
         c_acctbal >= 0 as is_current
  from customer),
batch as (
  select c_custkey as id, c_name as name,
         case when c_nationkey < 10 then '{moved}' else c_mktsegment end as city
  from customer where c_mktsegment <> 'BUILDING'
  union all
  select s_suppkey + 1000000000, s_name, 'SUPPLIER' from supplier),
changed as (
  select b.* from batch b join target t on b.id = t.id
  where t.is_current and b.city is distinct from t.city),
fresh as (
  select b.* from batch b where not exists (select 1 from target t where t.id = b.id)),
past_only as (
  select b.* from batch b where exists (select 1 from target t where t.id = b.id)
  and not exists (select 1 from target t where t.id = b.id and t.is_current)),
expired as (
  select t.id, t.name, t.city, t.eff_start,
         case when c.id is not null and t.is_current then date '2024-05-31' else t.eff_end end
           as eff_end,
         t.is_current and c.id is null as is_current
  from target t left join changed c on c.id = t.id),
applied as (
  select * from expired
  union all
  select *, date '2024-06-01', date '9999-12-31', true from changed
  union all
  select *, date '2024-06-01', date '9999-12-31', true from fresh)
"""
CUSTOMERS = CUSTOMER_CASE.format(moved="MOVED")
CUSTOMERS_AGAIN = CUSTOMER_CASE.format(moved="MOVED2")
APPLIED = CUSTOMERS + "select * from applied"

ORDER_CASE = """
with target as (
  select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status,
         o_orderpriority as priority, cast(o_orderdate as date) as eff_start,
         case when o_orderstatus = 'F' then cast(o_orderdate as date) + 90
              else date '9999-12-31' end as eff_end,
         o_orderstatus <> 'F' as is_current
  from orders),
batch as (
  select o_orderkey as order_id, o_custkey as customer_id,
         case when o_orderstatus = 'O' then 'F' else o_orderstatus end as status,
         case when o_orderpriority = '5-LOW' then '4-NOT SPECIFIED' else o_orderpriority end
           as priority
  from orders where o_orderdate >= timestamp '1997-01-01'),
changed as (
  select b.* from batch b join target t on b.order_id = t.order_id
  where t.is_current and (b.status <> t.status or b.priority <> t.priority)),
applied as (
  select t.order_id, t.customer_id, t.status, t.priority, t.eff_start,
         case when c.order_id is not null then date '2024-05-31' else t.eff_end end as eff_end,
         t.is_current and c.order_id is null as is_current
  from target t left join changed c on c.order_id = t.order_id
  union all
  select *, date '2024-06-01', date '9999-12-31', true from changed)
"""

SUPPLIER_CASE = """
with closed as (
  select case when l_quantity > 10 then 0 else l_suppkey end as id, l_linestatus as name,
         l_returnflag as city, cast(l_shipdate as date) as eff_start,
         cast(l_shipdate as date) as eff_end, false as is_current
  from lineitem),
target as (
  select * from closed
  union all
  select s_suppkey, s_name, cast(s_nationkey as varchar), date '2023-01-01',
         date '9999-12-31', true
  from supplier)
"""
LONG_HISTORY = (
    SUPPLIER_CASE
    + """
select * from closed
union all
select s_suppkey, s_name, cast(s_nationkey as varchar), date '2023-01-01',
       case when s_acctbal < 5000 then date '2024-05-31' else date '9999-12-31' end,
       coalesce(s_acctbal, 5000) >= 5000
from supplier
union all
select s_suppkey, s_name, 'MOVED', date '2024-06-01', date '9999-12-31', true
from supplier where s_acctbal < 5000
"""
)

CHECKED = """
, days as (
  select id, eff_start, count(*) as n, max(eff_end) as last_end,
         cast(count_if(is_current <> (eff_end = date '9999-12-31')) as bigint) as flag,
         cast(count_if(eff_start > eff_end) as bigint) as late,
         cast(count_if(is_current) as bigint) as cur
  from {versions} group by all),
checked as (
  select *, cast(sum(cur) over (partition by id) as bigint) as all_cur,
         max(last_end) over (partition by id order by eff_start
                             rows between unbounded preceding and 1 preceding) as earlier
  from days)
select id, eff_start, 'current_flag' as rule, flag as versions from checked where flag > 0
union all
select id, eff_start, 'start_after_end', late from checked where late > 0
union all
select id, eff_start, 'several_current', cur from checked where all_cur > 1 and cur > 0
union all
select id, eff_start, 'overlap', n from checked where n > 1 or earlier >= eff_start
"""

HOT_JOIN = """
select k as s_suppkey, l_orderkey, l_linenumber, l_quantity, s_name
from (select *, case when l_quantity > 10 then 0 else l_suppkey end as k from lineitem)
join supplier on s_suppkey = k
"""


def ranked(function: str) -> str:
    return f"""
select p_brand, p_partkey, p_size, cast({function}() over w as integer) as rnk from part
window w as (partition by p_brand order by p_size desc) qualify rnk <= 3
"""


ORACLE: dict[str, str] = {
    "nested_explode_outer": SHIPMENTS_OUTER,
    "nested_explode_inner": SHIPMENTS_INNER,
    "nested_explode_position": """
with pieces as (
  select doc_id, lang, source, unnest(string_split(text, chr(10))) as body,
         unnest(generate_series(1, len(string_split(text, chr(10))))) as i
  from documents where contains(text, chr(10))),
filled as (
  select *, row_number() over (partition by doc_id order by i) as nth from pieces where body <> '')
select doc_id, lang, source, cast(nth - 1 as integer) as line_no, body,
       cast(length(body) as integer) as n_chars
from filled
union all
select doc_id, lang, source, null, null, null from documents
where doc_id not in (select doc_id from filled)
""",
    "nested_filter_parents": f"select * from ({SHIPMENTS_OUTER}) where ship_status = 'O'",
    "nested_row_counts": f"""
select (select count(*) from lineitem) as records,
       (select count(*) from ({SHIPMENTS_OUTER})) as outer_rows,
       (select count(*) from ({SHIPMENTS_INNER})) as inner_rows
""",
    "nested_flatten_structs": """
select c_custkey, c_name, n_name as nation_name, r_name as nation_region_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "nested_map_explode": """
select c_custkey, 'name' as key, c_name as value from customer
union all
select c_custkey, 'segment', c_mktsegment from customer
""",
    "json_parse_explode": SHIPMENTS_OUTER,
    "json_event_props": """
select event_id, cast(json_extract(props, '$.k') as integer) as k from events
""",
    "json_inferred_schema": """
select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
""",
    "json_rejects": """
select 'document' as kind, doc_id as id, text as raw_text from documents
where text <> '' and not json_valid(text)
""",
    "json_accepted": """
select 'event' as kind, event_id as id, cast(json_extract(props, '$.k') as integer) as k
from events
union all
select 'document', doc_id, null from documents where text = '' or json_valid(text)
""",
    "scd2_changed": CUSTOMERS + "select * from changed",
    "scd2_new": CUSTOMERS + "select * from fresh",
    "scd2_classify": CUSTOMERS
    + """
select *, case when id in (select id from fresh) then 'new'
               when id in (select id from past_only) then 'closed_only'
               when id in (select id from changed) then 'changed'
               else 'unchanged' end as change_type
from batch
""",
    "scd2_expire": CUSTOMERS + "select * from expired",
    "scd2_apply": APPLIED,
    "scd2_apply_reopen": APPLIED
    + " union all select *, date '2024-06-01', date '9999-12-31', true from past_only",
    "scd2_apply_shuffled": APPLIED,
    "scd2_apply_orders": ORDER_CASE + "select * from applied",
    "scd2_long_history": LONG_HISTORY,
    "scd2_long_history_shuffled": LONG_HISTORY,
    "scd2_long_history_violations": SUPPLIER_CASE + CHECKED.format(versions="target"),
    "scd2_actions": ORDER_CASE
    + """
select * from (
  select 'expired' as action, (select count(*) from changed) as versions
  union all
  select 'changed', (select count(*) from changed)
  union all
  select 'kept', (select count(*) from target t where is_current
                  and not exists (select 1 from batch b where b.order_id = t.order_id))
  union all
  select 'unchanged', (select count(*) from batch b join target t on t.order_id = b.order_id
                       where is_current) - (select count(*) from changed))
where versions > 0
""",
    "scd2_metrics": CUSTOMERS
    + """
select (select count(*) from changed) as expired,
       (select count(*) from changed) as inserted_changed,
       (select count(*) from fresh) as inserted_new,
       cast(0 as bigint) as reopened, cast(0 as bigint) as amended,
       (select count(*) from past_only) as closed_skipped,
       (select count(*) from batch) - (select count(*) from changed)
         - (select count(*) from fresh) - (select count(*) from past_only) as unchanged
""",
    "scd2_rerun": APPLIED,
    "scd2_same_day": CUSTOMERS_AGAIN + "select * from applied",
    "scd2_violations": CUSTOMERS + CHECKED.format(versions="applied"),
    "scd2_violations_found": ORDER_CASE
    + ", versions as (select * exclude (customer_id), customer_id as id from target)"
    + CHECKED.format(versions="versions"),
    "scd2_ordered": APPLIED + " order by id, eff_start",
    "merge_update": CUSTOMERS
    + """
select t.id, t.name,
       case when b.id is not null and t.is_current and b.city <> t.city then b.city
            else t.city end as city,
       t.eff_start, t.eff_end, t.is_current
from target t left join batch b on b.id = t.id
""",
    "merge_upsert": CUSTOMERS
    + """
select t.id, case when b.id is not null then b.name else t.name end as name,
       case when b.id is not null then b.city else t.city end as city,
       t.eff_start, t.eff_end, t.is_current
from target t left join batch b on b.id = t.id
union all
select *, date '2024-06-01', date '9999-12-31', true from fresh
""",
    "scd1_apply": CUSTOMERS
    + """
select t.id, case when b.id is not null then b.name else t.name end as name,
       case when b.id is not null then b.city else t.city end as city
from target t left join batch b on b.id = t.id
union all
select * from fresh
""",
    "publish_roundtrip": APPLIED,
    "publish_flat_items": SHIPMENTS_OUTER,
    "append_by_name": CUSTOMERS
    + "select id, name, city from target union all select id, name, city from batch",
    "dimension_commit": ORDER_CASE + "select * from applied",
    "dimension_history": ORDER_CASE
    + """
select cast(0 as bigint) as version, 'CREATE' as operation, cast(null as bigint) as expired,
       cast(null as bigint) as inserted_changed, cast(null as bigint) as inserted_new,
       cast(null as bigint) as unchanged
union all
select 1, 'SCD2', (select count(*) from changed), (select count(*) from changed), 0,
       (select count(*) from batch b join target t on t.order_id = b.order_id where is_current)
         - (select count(*) from changed)
""",
    "frozen_changes": CUSTOMERS
    + "select *, date '2024-06-01' as eff_start, date '9999-12-31' as eff_end, "
    "true as is_current from changed",
    "dedup_latest": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey, l_suppkey, l_extendedprice) = 1
""",
    "dedup_documents": """
select min(doc_id) as doc_id, count(*) as copies from documents group by text
""",
    "dedup_rows": "select distinct l_orderkey, l_linenumber from lineitem",
    "topn_row_number": """
select p_brand, p_partkey, p_size,
       cast(row_number() over (partition by p_brand order by p_size desc, p_partkey) as integer)
         as rn
from part qualify rn <= 3
""",
    "topn_rank": ranked("rank"),
    "topn_dense_rank": ranked("dense_rank"),
    "topn_pruned": """
select o_orderkey, o_totalprice, o_orderstatus,
       cast(rank() over (partition by o_orderstatus order by o_totalprice desc) as integer) as rnk
from orders where o_orderstatus = 'F' qualify rnk <= 5
""",
    "skew_salted_join": HOT_JOIN,
    "skew_broadcast_join": HOT_JOIN,
    "skew_aqe_join": HOT_JOIN,
}

ORACLE |= {
    "skew_broadcast_fallback": HOT_JOIN,
    "skew_both_hot": """
with names as (
  select s_suppkey, s_name from supplier union all select 0, n_name from nation),
lines as (select case when l_quantity > 10 then 0 else l_suppkey end as k, l_quantity from lineitem)
select s_name, count(*) as lines, sum(l_quantity) as quantity
from lines join names on s_suppkey = k group by s_name
""",
    "topn_rank_salted": ranked("rank"),
    "topn_dense_rank_salted": ranked("dense_rank"),
    "topn_row_number_large": """
select event_id, event_type, value,
       cast(row_number() over (partition by event_type order by value desc, event_id) as integer)
         as rn
from events qualify rn <= 1500
""",
}
ORACLE |= {
    "nested_explode_scalars": """
select doc_id, cast(unnest(range(len(l))) as integer) as n, unnest(l) as line
from (select doc_id, string_split(text, chr(10)) as l from documents)
""",
    "json_nested_items": "select p_brand as brand, p_partkey as id, p_size as size from part",
}
AGAIN = CUSTOMERS_AGAIN + """
, classified as (
  select *, case when id in (select id from past_only) then 'closed_only'
                 when id in (select id from changed) then 'amended'
                 else 'unchanged' end as change_type
  from batch)
"""
LATE = CUSTOMERS.replace("2024-06-01", "2023-06-01").replace("2024-05-31", "2023-05-31")
ORACLE |= {
    "scd2_classify_same_day": AGAIN + "select * from classified",
    "scd2_metrics_same_day": AGAIN
    + """
select cast(0 as bigint) as expired, cast(0 as bigint) as inserted_changed,
       cast(0 as bigint) as inserted_new, cast(0 as bigint) as reopened,
       count_if(change_type = 'amended')::bigint as amended,
       count_if(change_type = 'closed_only')::bigint as closed_skipped,
       count_if(change_type = 'unchanged')::bigint as unchanged
from classified
""",
    "scd2_reopen_late": LATE
    + """
, reopened as (
  select * from applied
  union all
  select *, date '2023-06-01', date '9999-12-31', true from past_only)
"""
    + CHECKED.format(versions="reopened"),
    "scd2_missing_dates": """
select o_orderkey as order_id,
       case when o_orderpriority <> '1-URGENT' then cast(o_orderdate as date) end as eff_start,
       'missing_date' as rule, cast(1 as bigint) as versions
from orders where o_orderpriority = '1-URGENT' or o_orderstatus = 'P'
""",
    "append_history": CUSTOMERS
    + """
select cast(1 as bigint) as version, 'PUBLISH' as operation, cast(null as bigint) as rows
union all
select 2, 'APPEND', count(*) from batch
union all
select 3, 'APPEND', count(*) from target
""",
}
ORACLE |= {
    "skew_mixed_types": """
select lpad(cast(k as varchar), case when l_quantity > 30 then 7 else 12 end, '0') as s_suppkey,
       l_orderkey, l_linenumber, l_quantity, s_name
from (select *, case when l_quantity > 10 then 0 else l_suppkey end as k from lineitem)
left join supplier on s_suppkey = k
""",
    "merge_upsert_mixed_types": CUSTOMERS
    + """
select lpad(cast(o_custkey as varchar), 9, '0') as id, o_orderkey as number,
       case when b.id is not null then b.name else o_orderpriority end as name
from orders left join batch b on b.id = o_custkey
union all
select cast(id as varchar), null, name from batch
where id not in (select o_custkey from orders)
""",
}
ORACLE |= {
    "dimension_commit_buckets": ORDER_CASE + "select * from applied",
    "dimension_replay": CUSTOMERS
    + """
select * from expired
union all
select *, date '2024-06-01', date '2024-06-30', false from changed
union all
select id, name, 'MOVED2', date '2024-07-01', date '9999-12-31', true from changed
union all
select *, date '2024-06-01', date '9999-12-31', true from fresh
""",
    "dimension_replay_history": CUSTOMERS
    + """
, stay as (
  select count(*) as n from batch b join target t on b.id = t.id
  where is_current and not exists (select 1 from changed c where c.id = b.id))
select cast(0 as bigint) as version, 'CREATE' as operation, cast(null as bigint) as expired,
       cast(null as bigint) as inserted_new, cast(null as bigint) as unchanged
union all
select 1, 'SCD2', (select count(*) from changed), (select count(*) from fresh), (select n from stay)
union all
select 2, 'SCD2', (select count(*) from changed), 0,
       (select n from stay) + (select count(*) from fresh)
union all
select 3, 'REPLAY', null, null, null
""",
    "dimension_rejected": APPLIED,
}
ORACLE |= {
    "scd2_change_log": """
with target as (
  select c_custkey as id, c_name as name, c_mktsegment as city, date '1990-01-01' as eff_start,
         case when c_acctbal >= 0 then date '9999-12-31' else date '1991-01-01' end as eff_end,
         c_acctbal >= 0 as is_current
  from customer),
log as (
  select case when o_totalprice > 150000 then -1 else o_custkey end as id, 'ordered' as name,
         o_orderpriority as city, cast(o_orderdate as date) as eff_start
  from orders
  qualify row_number() over (partition by id, eff_start order by o_orderkey desc) = 1),
events as (
  select id, name, city, eff_start from log
  where id not in (select id from target where not is_current)
  union all
  select id, name, city, eff_start from target where is_current),
starts as (
  select * from events
  qualify lag(city) over (partition by id order by eff_start) is distinct from city)
select *, coalesce(lead(eff_start) over (partition by id order by eff_start) - 1, date '9999-12-31') as eff_end,
       lead(eff_start) over (partition by id order by eff_start) is null as is_current
from starts
union all
select * from target where not is_current
""",
    "scd2_apply_late": CUSTOMERS
    + """
, moved as (
  select b.id, b.name from batch b where b.city = 'MOVED' and b.id in (select id from target where is_current)),
rest as (select * from applied where id not in (select id from moved))
select id, name, city, date '2023-01-01' as eff_start, date '2023-09-30' as eff_end, false as is_current
from target where id in (select id from moved)
union all
select id, name, 'LATE', date '2023-10-01', date '2024-05-31', false from moved
union all
select id, name, 'LATER', date '2024-06-01', date '9999-12-31', true from moved
union all
select * from rest
union all
select id, name, city, date '2023-10-01', date '2024-05-31', false from fresh
""",
}
ORACLE |= {
    "topn_dynamic_pruned": """
select c_custkey, c_acctbal, c_nationkey,
       cast(row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as integer) as rn
from customer
where c_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey
                      where r_name in ('EUROPE', 'ASIA'))
qualify rn <= 3
""",
    "skew_salted_aggregate": """
select case when l_quantity > 10 then 0 else l_suppkey end as s_suppkey, count(*) as lines,
       sum(l_quantity) as quantity, min(l_quantity) as least, max(l_quantity) as most,
       count(distinct l_orderkey) as orders, true as near, true as middle
from lineitem group by 1
""",
}
ORACLE |= {
    "json_variant_explode": SHIPMENTS_OUTER,
    "json_schema_evolved": """
select 'event' as kind, event_id as id, cast(json_extract(props, '$.k') as double) as k,
       cast(null as varchar) as status, cast(null as varchar) as detail_priority,
       cast(null as varchar) as detail_brand, cast(null as bigint) as detail_size
from events
union all
select 'order', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, null, null from orders
union all
select 'part', p_partkey, p_size + 0.5, null, null, p_brand, p_size from part
""",
    "json_schema_changes": """
select cast(batch as bigint) as batch, change from (values
  (1, '+ k: bigint'),
  (2, '+ status: string'), (2, '+ detail: struct<priority:string>'),
  (3, 'k: bigint -> double'), (3, '+ detail.brand: string'), (3, '+ detail.size: bigint')) v(batch, change)
where exists (select 1 from events) and exists (select 1 from orders) and exists (select 1 from part)
""",
}
# The plans for large batches give the same rows.
for name in ("scd2_change_log", "scd2_apply_late", "merge_update", "merge_upsert", "scd1_apply", "scd2_classify", "scd2_expire"):
    ORACLE[f"{name}_shuffled"] = ORACLE[name]
