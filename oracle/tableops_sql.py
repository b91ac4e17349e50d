"""DuckDB oracle SQL for the table write patterns C1-C13."""

from __future__ import annotations

from oracle.dims_traces_sql import F1_SQL, F4_SQL
from oracle.fixtures_sql import cte
from oracle.gold_sql import G10_SQL, G14_SQL, H4_SQL

_MERGE = """
WITH t AS (select s_suppkey, s_name as old_s_name, s_nationkey as old_s_nationkey,
                  timestamp '2001-07-01 00:00:00' as old_loaded from supplier where s_suppkey % 3 <> 0),
s AS (select s_suppkey, case when s_suppkey % 5 = 0 then s_name || ' (nowa)' else s_name end as new_s_name,
             s_nationkey as new_s_nationkey from supplier),
j AS (select coalesce(t.s_suppkey, s.s_suppkey) as s_suppkey, t.old_s_name, t.old_s_nationkey, t.old_loaded,
             s.new_s_name, s.new_s_nationkey,
             case when t.s_suppkey is null then 'I'
                  when s.s_suppkey is not null and (t.old_s_name is distinct from s.new_s_name
                       or t.old_s_nationkey is distinct from s.new_s_nationkey) then 'U' end as op
      from t full outer join s on t.s_suppkey = s.s_suppkey)"""

C1_SQL = _MERGE + """
select s_suppkey,
       case when op is not null then new_s_name else old_s_name end as s_name,
       case when op is not null then new_s_nationkey else old_s_nationkey end as s_nationkey,
       strftime(case when op is not null then timestamp '2001-08-02 06:00:00' else old_loaded end,
                '%Y-%m-%d %H:%M:%S') as loaded_at
from j"""

C10_SQL = _MERGE + """,
e AS (select s_suppkey, 's_name' as column_name, old_s_name as old_value, new_s_name as new_value from j
      where op is not null
      union all
      select s_suppkey, 's_nationkey', cast(old_s_nationkey as varchar), cast(new_s_nationkey as varchar) from j
      where op is not null)
select 'supplier' as table_name, cast(s_suppkey as varchar) as business_key, column_name, old_value, new_value,
       '2001-08-02 06:00:00' as changed_at, 'perron' as changed_by
from e where old_value is distinct from new_value"""

C2_SQL = cte("fx_plan", "fx_run", "fx_stop_raw") + """,
stored AS (select p.schedule_id, p.order_id, p.order_number from fx_plan p
           where exists (select 1 from fx_run r where r.operating_date <= date '2001-07-27'
                         and r.schedule_id = p.schedule_id and r.order_id = p.order_id)),
b AS (select * from (
        select cast(2001 as bigint) as schedule_id, l_orderkey as order_id, l_linenumber as order_number,
               l_suppkey % 10 as dsta_id,
               row_number() over (partition by l_orderkey, l_linenumber
                                  order by l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn
        from fx_stop_raw) where rn = 1)
select schedule_id, order_id, order_number, dsta_id from b
where not exists (select 1 from stored s where s.schedule_id = b.schedule_id and s.order_id = b.order_id
                  and s.order_number = b.order_number)"""

C3_SQL = cte("fx_city", "fx_station") + """
select c.id, c.name, exists (select 1 from fx_station s where s.dcit_id = c.id) as is_active from fx_city c"""

C4_SQL = cte("fx_run") + """,
b AS (select * from fx_run where train_status <> 'X' and operating_date between date '2001-07-26' and date '2001-07-30'),
w AS (select min(operating_date) lo, max(operating_date) hi from b)
select strftime(r.operating_date, '%Y-%m-%d') as operating_date, r.schedule_id, r.order_id, r.train_order_id,
       case when r.operating_date between w.lo and w.hi
            then case when exists (select 1 from b where b.operating_date = r.operating_date
                                   and b.schedule_id = r.schedule_id and b.order_id = r.order_id
                                   and b.train_order_id = r.train_order_id) then 1 else 0 end
            else 1 end as is_active
from fx_run r, w"""

C11_SQL = cte("fx_plan", "fx_run", "fx_ends") + """,
first AS (select distinct arg_min(dsta_id, order_number) as from_station_id,
                          arg_max(dsta_id, order_number) as to_station_id
          from fx_plan p
          where exists (select 1 from fx_run r where r.operating_date = date '2001-07-23'
                        and r.schedule_id = p.schedule_id and r.order_id = p.order_id)
          group by schedule_id, order_id),
ex AS (select cast(dense_rank() over (order by from_station_id, to_station_id) as bigint) as id, * from first),
allr AS (select distinct from_station_id, to_station_id from fx_ends),
nw AS (select * from allr a where not exists (select 1 from ex where ex.from_station_id = a.from_station_id
                                              and ex.to_station_id = a.to_station_id))
select id, from_station_id, to_station_id from ex
union all
select cast((select coalesce(max(id), 0) from ex) + dense_rank() over (order by from_station_id, to_station_id)
            as bigint), from_station_id, to_station_id from nw"""

SQL = {
    "c1_merge_upsert": C1_SQL,
    "c10_audit_changes": C10_SQL,
    "c2_insert_new": C2_SQL,
    "c3_deactivate_missing": C3_SQL,
    "c4_sync_flag": C4_SQL,
    "c7_recompute_days": G10_SQL,
    "c8_recompute_months": G14_SQL,
    "c9_insert_missing": F1_SQL,
    "c11_assign_ids": C11_SQL,
    "c12_materialize": H4_SQL,
    "c13_publish": F4_SQL,
}

SQL["c13_daily_job"] = G10_SQL
