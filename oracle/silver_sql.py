"""DuckDB oracle SQL for shredding (B) and silver loaders (D): the plain
relational form of what the JSON documents carry."""

from __future__ import annotations

from oracle.fixtures_sql import cte

TS = "'%Y-%m-%d %H:%M:%S'"

B1_SQL = cte("fx_station") + "select id, name from fx_station"

_ROUTES = cte("fx_run", "fx_plan") + """,
rt AS (select * from fx_run r where exists (select 1 from fx_plan p where p.schedule_id = r.schedule_id
                                            and p.order_id = r.order_id))"""

B2_SQL = _ROUTES + """
select strftime(operating_date, '%Y-%m-%d') as operating_date, schedule_id, order_id, train_order_id,
       'Pociag ' || cast(order_id as varchar) as name, carrier_code, category_code,
       cast(order_id as varchar) as national_number
from rt"""

B3_SQL = cte("fx_run", "fx_stop") + f"""
select strftime(r.operating_date, '%Y-%m-%d') as operating_date, r.order_id, r.train_status, s.dsta_id,
       s.planned_sequence, s.actual_sequence,
       strftime(make_timestamp(s.arr_sec * 1000000), {TS}) as actual_arrival,
       strftime(make_timestamp(s.dep_sec * 1000000), {TS}) as actual_departure,
       s.arrival_delay_min, s.departure_delay_min, s.is_confirmed, s.is_cancelled
from fx_run r left join fx_stop s on s.ophe_id = r.ophe_id"""

B4_SQL = cte("fx_disr0") + """
select disruption_id, disruption_type_code, message, strftime(operating_date, '%Y-%m-%d') as operating_date,
       cast(2001 as bigint) as schedule_id, l_orderkey as order_id, l_orderkey as train_order_id,
       l_suppkey % 10 as dsta_id, l_linenumber as sequence_number
from fx_disr0"""

_CITIES = cte("fx_station", "fx_city") + """,
mem AS (select dcit_id, count(*) as station_count from fx_station group by dcit_id),
cities AS (select dense_rank() over (order by c.name) as id, c.id as nation_id, c.name,
                  cast(m.station_count as integer) as station_count
           from fx_city c join mem m on m.dcit_id = c.id)"""

B5_SQL = _CITIES + """
select c.name as city_name, c.station_count, s.id as station_id
from cities c join fx_station s on s.dcit_id = c.nation_id"""

B6_SQL = cte("fx_cause") + "select code, description from fx_cause"

D2_SQL = _CITIES + "\nselect cast(id as bigint) as id, name, station_count, true as is_active from cities"

D3_SQL = _CITIES + """
select s.id, s.name, cast(c.id as bigint) as dcit_id from fx_station s left join cities c on c.nation_id = s.dcit_id"""

D6_SQL = cte("fx_status") + "select code, name from fx_status"
D7_SQL = B6_SQL

D8_SQL = _ROUTES + """
select strftime(operating_date, '%Y-%m-%d') as operating_date, schedule_id, order_id, train_order_id,
       'Pociag ' || cast(order_id as varchar) as name, carrier_code, category_code,
       cast(order_id as varchar) as national_number, 1 as is_active
from rt"""

D9_SQL = cte("fx_plan") + "select * from fx_plan"

_SETTLED = cte("fx_run", "fx_stop") + """,
x AS (select r.*, s.planned_sequence, coalesce(s.is_cancelled, false) as canc,
             coalesce(s.is_confirmed, false) as conf
      from fx_run r left join fx_stop s on s.ophe_id = r.ophe_id),
k AS (select *, case when not canc then planned_sequence end as ok_seq,
             case when not canc and conf then 1 when not canc then 0 end as v from x),
m AS (select ophe_id, max(ok_seq) as mk from k group by ophe_id),
g AS (select k.ophe_id, k.operating_date, k.schedule_id, k.order_id, k.train_order_id, k.train_status,
             max(case when not canc then 1 else 0 end) as has_noncanc,
             max(case when m.mk is null or k.ok_seq = m.mk then v end) as last_conf
      from k join m on m.ophe_id = k.ophe_id
      group by k.ophe_id, k.operating_date, k.schedule_id, k.order_id, k.train_order_id, k.train_status),
settled AS (select * from g where train_status in ('C', 'X') or (train_status = 'Q' and last_conf = 1)
                               or (train_status = 'Q' and has_noncanc = 0))"""

D10_SQL = _SETTLED + """
select strftime(operating_date, '%Y-%m-%d') as operating_date, schedule_id, order_id, train_order_id, train_status,
       strftime(operating_date + 1, '%Y-%m-%d') || ' 06:00:00' as snapshot_ts
from settled"""

D11_SQL = _SETTLED + f"""
select strftime(st.operating_date, '%Y-%m-%d') as operating_date, st.order_id, s.planned_sequence,
       s.actual_sequence, s.dsta_id,
       strftime(make_timestamp(s.arr_sec * 1000000), {TS}) as actual_arrival,
       strftime(make_timestamp(s.dep_sec * 1000000), {TS}) as actual_departure,
       s.is_confirmed, s.is_cancelled, s.arrival_delay_min, s.departure_delay_min,
       s.dep_sec - s.arr_sec as dwell_time_sec
from settled st join fx_stop s on s.ophe_id = st.ophe_id"""

D12_SQL = cte("fx_disr0") + """
select cast(strftime(operating_date, '%Y%m%d') as bigint) * 10000000000 + disruption_id as id,
       disruption_type_code, message
from fx_disr0"""

D13_SQL = cte("fx_dis_details") + """
select strftime(operating_date, '%Y-%m-%d') as operating_date, schedule_id, order_id, dsta_id, dihe_id,
       train_order_id, sequence_number
from fx_dis_details"""

SQL = {
    "b1_station_rows": B1_SQL, "b2_route_dates": B2_SQL, "b3_operation_stops": B3_SQL,
    "b4_disruption_rows": B4_SQL, "b5_city_members": B5_SQL, "b6_map_entries": B6_SQL,
    "d2_def_city": D2_SQL, "d3_def_station": D3_SQL, "d6_def_train_status": D6_SQL,
    "d7_def_disruption_cause": D7_SQL, "d8_schedule_header": D8_SQL, "d9_schedule_details": D9_SQL,
    "d10_operation_header": D10_SQL, "d11_operation_details": D11_SQL, "d12_disruption_header": D12_SQL,
    "d13_disruption_details": D13_SQL,
}


def _summed(name: str, sql: str, columns: list[str]) -> str:
    text = "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in columns) + ")"
    return f"select '{name}' as table_name, count(*) as n_rows, cast(sum(cast('0x' || substr(md5({text}), 1, 8) as bigint)) as bigint) as checksum from ({sql})"


# the loaded tables are those of D2-D13, whatever order their documents came in
SQL["d_load_all"] = " union all ".join(_summed(n, q, c) for n, q, c in [
    ("def_city", D2_SQL, ["id", "name", "station_count", "is_active"]), ("def_station", D3_SQL, ["id", "name", "dcit_id"]),
    ("def_train_status", D6_SQL, ["code", "name"]), ("def_disruption_cause", D7_SQL, ["code", "description"]),
    ("schedule_header", D8_SQL, ["operating_date", "schedule_id", "order_id", "train_order_id", "name", "carrier_code", "category_code", "national_number", "is_active"]),
    ("schedule_details", D9_SQL, ["schedule_id", "order_id", "order_number", "dsta_id", "arrival_time", "arrival_day", "departure_time", "departure_day", "departure_platform", "dstty_id"]),
    ("operation_header", D10_SQL, ["operating_date", "schedule_id", "order_id", "train_order_id", "train_status", "snapshot_ts"]),
    ("operation_details", D11_SQL, ["operating_date", "order_id", "planned_sequence", "actual_sequence", "dsta_id", "actual_arrival", "actual_departure", "is_confirmed", "is_cancelled",
                                    "arrival_delay_min", "departure_delay_min", "dwell_time_sec"]),
    ("disruption_header", D12_SQL, ["id", "disruption_type_code", "message"]),
    ("disruption_details", D13_SQL, ["operating_date", "schedule_id", "order_id", "dsta_id", "dihe_id", "train_order_id", "sequence_number"])])
