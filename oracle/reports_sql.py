"""DuckDB oracle SQL for the gold report views H5-H13."""

from __future__ import annotations

from oracle.gold_sql import (DIS_BASE, DIS_CTES, DIS_KEYS_M, DIS_MONTHLY, G14_CTE, _base, _cast_all, avg2,
                             pct, stop_daily_ctes, stop_monthly_cte)

STATION = 3

TYPE_NAMES = """(select category_code, carrier_code, strftime(valid_from, '%Y-%m-%d') as type_valid_from,
             category_name, carrier_name from fx_train_type)"""

HOURS = """(select h as hour_id, lpad(cast(h as varchar),2,'0') || ':00-' || lpad(cast(h as varchar),2,'0') || ':59'
            as hour_label from range(24) t(h))"""

ROUTE_JOIN = """join fx_station fs on fs.id = a.from_station_id
join fx_station ts on ts.id = a.to_station_id"""

TYPE_JOIN = f"""join {TYPE_NAMES} t on t.category_code = a.category_code and t.carrier_code = a.carrier_code
  and t.type_valid_from = a.type_valid_from"""

RK = "from_station_id, to_station_id, category_code, carrier_code, type_valid_from"

H5_SQL = G14_CTE + f""",
a AS (
  select month, {RK}, day_type,
         sum(runs_count) as runs_total,
         sum(case when delayed_count is not null then runs_count end) as runs_completed,
         sum(case when delayed_count is null then runs_count end) as cancelled_count,
         sum(delayed_count) as delayed_count,
         sum(sum_terminal_delay_min) as sum_terminal_delay_min,
         sum(sum_delayed_delay_min) as sum_delayed_delay_min,
         max(max_terminal_delay_min) as max_terminal_delay_min,
         sum(travel_runs_count) as travel_runs_count,
         sum(sum_planned_travel_min) as sum_planned_travel_min,
         sum(sum_actual_travel_min) as sum_actual_travel_min,
         min(min_actual_travel_min) as min_actual_travel_min,
         max(max_actual_travel_min) as max_actual_travel_min
  from fm group by month, {RK}, day_type)
select a.month, a.day_type, fs.name || ' -> ' || ts.name as route_name, t.category_name, t.carrier_name,
       a.from_station_id, a.to_station_id, a.category_code, a.carrier_code, a.type_valid_from,
       {_cast_all(['runs_total', 'runs_completed', 'cancelled_count', 'delayed_count'])},
       cast(runs_completed - delayed_count as bigint) as on_time_count,
       {_cast_all(['sum_terminal_delay_min', 'sum_delayed_delay_min', 'max_terminal_delay_min',
                   'travel_runs_count', 'sum_planned_travel_min', 'sum_actual_travel_min',
                   'min_actual_travel_min', 'max_actual_travel_min'])},
       {pct('runs_completed - delayed_count', 'runs_completed')} as on_time_pct,
       {pct('delayed_count', 'runs_completed')} as delayed_pct,
       {pct('cancelled_count', 'runs_total')} as cancelled_pct,
       {avg2('sum_terminal_delay_min', 'runs_completed')} as avg_terminal_delay_min,
       {avg2('sum_delayed_delay_min', 'delayed_count')} as avg_delayed_delay_min,
       {avg2('sum_planned_travel_min', 'travel_runs_count')} as avg_planned_travel_min,
       {avg2('sum_actual_travel_min', 'travel_runs_count')} as avg_actual_travel_min
from a {ROUTE_JOIN} {TYPE_JOIN}
"""

H6_SQL = G14_CTE + f""",
a AS (
  select month, {RK}, status_code,
         sum(runs_count) as runs_count, sum(delayed_count) as delayed_count,
         sum(sum_terminal_delay_min) as sum_terminal_delay_min,
         sum(sum_delayed_delay_min) as sum_delayed_delay_min,
         max(max_terminal_delay_min) as max_terminal_delay_min
  from fm group by month, {RK}, status_code),
b AS (
  select a.*, fs.name || ' -> ' || ts.name as route_name, t.category_name, t.carrier_name, st.name as status_name
  from a {ROUTE_JOIN} {TYPE_JOIN}
  join fx_status st on st.code = a.status_code),
c AS (select b.*, sum(runs_count) over (partition by month, {RK}) as runs_total_month from b)
select month, route_name, category_name, carrier_name, status_name, {RK}, status_code,
       {_cast_all(['runs_count', 'delayed_count', 'sum_terminal_delay_min', 'sum_delayed_delay_min',
                   'max_terminal_delay_min', 'runs_total_month'])},
       {pct('runs_count', 'runs_total_month')} as share_pct
from c
"""

_STOP_BASE = _base("fx_plan")

H7_SQL = _STOP_BASE + stop_daily_ctes("arr") + stop_monthly_cte("arr") + f""",
a AS (
  select month, from_station_id, to_station_id, station_id, hour_id, category_code, carrier_code, type_valid_from,
         sum(arrivals_count) as arrivals_count, sum(arrivals_on_time) as arrivals_on_time,
         sum(arrivals_delayed) as arrivals_delayed, sum(sum_arrival_delay_min) as sum_arrival_delay_min,
         sum(sum_delayed_delay_min) as sum_delayed_delay_min, max(max_arrival_delay_min) as max_arrival_delay_min,
         sum(cancelled_count) as cancelled_count
  from m_arr group by month, from_station_id, to_station_id, station_id, hour_id, category_code, carrier_code,
                      type_valid_from)
select a.month, fs.name || ' -> ' || ts.name as route_name, ss.name as station_name, h.hour_label,
       t.category_name, t.carrier_name, a.from_station_id, a.to_station_id, a.station_id, a.hour_id,
       a.category_code, a.carrier_code, a.type_valid_from,
       {_cast_all(['arrivals_count', 'arrivals_on_time', 'arrivals_delayed', 'sum_arrival_delay_min',
                   'sum_delayed_delay_min', 'max_arrival_delay_min', 'cancelled_count'])},
       {pct('arrivals_on_time', 'arrivals_count')} as on_time_pct,
       {pct('arrivals_delayed', 'arrivals_count')} as delayed_pct,
       {avg2('sum_arrival_delay_min', 'arrivals_count')} as avg_arrival_delay_min,
       {avg2('sum_delayed_delay_min', 'arrivals_delayed')} as avg_delayed_delay_min,
       {pct('cancelled_count', 'arrivals_count + cancelled_count')} as cancelled_pct
from a {ROUTE_JOIN}
join fx_station ss on ss.id = a.station_id
join {HOURS} h on h.hour_id = a.hour_id
{TYPE_JOIN}
"""

H8_SQL = DIS_BASE + DIS_CTES + DIS_MONTHLY + f""",
a AS (
  select month, from_station_id, to_station_id, station_id, category_code, carrier_code, type_valid_from,
         cause_code, sum(occurrences_count) as occurrences_count
  from m_dis group by month, from_station_id, to_station_id, station_id, category_code, carrier_code,
                      type_valid_from, cause_code),
b AS (
  select a.*, fs.name || ' -> ' || ts.name as route_name, ss.name as station_name, t.category_name,
         t.carrier_name, c.description as cause_name
  from a {ROUTE_JOIN}
  join fx_station ss on ss.id = a.station_id
  {TYPE_JOIN}
  join fx_cause c on c.code = a.cause_code),
c AS (select b.*, sum(occurrences_count) over (partition by month, from_station_id, to_station_id, station_id)
             as occurrences_total from b)
select month, route_name, station_name, category_name, carrier_name, cause_name,
       from_station_id, to_station_id, station_id, category_code, carrier_code, type_valid_from, cause_code,
       cast(occurrences_count as bigint) as occurrences_count, cast(occurrences_total as bigint) as occurrences_total,
       {pct('occurrences_count', 'occurrences_total')} as share_pct
from c
"""

H9_SQL = _base("fx_plan") + """,
x AS (
  select r.*, od.actual_sequence, od.planned_sequence, od.dsta_id, od.arr_sec, od.dep_sec, od.is_confirmed,
         od.is_cancelled, od.arrival_delay_min, od.departure_delay_min, ds.name as station_name
  from fx_run r
  join fx_stop od on od.ophe_id = r.ophe_id
  join fx_station ds on ds.id = od.dsta_id),
rel AS (
  select ophe_id, arg_min(station_name, planned_sequence * 100000 + actual_sequence) || ' -> ' ||
                  arg_max(station_name, planned_sequence * 100000 + actual_sequence) as relation
  from x group by ophe_id)
select strftime(x.operating_date, '%Y-%m-%d') as operating_date, x.ophe_id, x.schedule_id, x.order_id,
       x.train_order_id, x.category_code, x.carrier_code, cast(x.order_id as varchar) as national_number,
       'Pociag ' || cast(x.order_id as varchar) as train_name, rel.relation,
       x.planned_sequence as stop_seq, x.actual_sequence, x.dsta_id as station_id, x.station_name,
       sd.arrival_time as planned_arrival_time, sd.departure_time as planned_departure_time,
       strftime(make_timestamp(x.arr_sec * 1000000), '%Y-%m-%d %H:%M:%S') as actual_arrival,
       strftime(make_timestamp(x.dep_sec * 1000000), '%Y-%m-%d %H:%M:%S') as actual_departure,
       x.is_confirmed, x.is_cancelled, x.arrival_delay_min, x.departure_delay_min,
       case when x.is_confirmed and not x.is_cancelled then coalesce(x.arrival_delay_min, 0) end
         as eff_arrival_delay_min,
       case when x.is_confirmed and not x.is_cancelled then coalesce(x.departure_delay_min, 0) end
         as eff_departure_delay_min
from x join rel on rel.ophe_id = x.ophe_id
left join fx_plan sd on sd.schedule_id = x.schedule_id and sd.order_id = x.order_id
                    and sd.order_number = x.planned_sequence
"""

_BOTH = _STOP_BASE + stop_daily_ctes("arr") + stop_daily_ctes("dep")
_BOTH_M = _BOTH + stop_monthly_cte("arr") + stop_monthly_cte("dep")

MONTH_TXT = "substr(cast(month as varchar),1,4) || '-' || substr(cast(month as varchar),5,2)"

H10_SQL = _BOTH_M + f""",
z AS (
  select month, 'P' as kierunek, hour_id, arrivals_count as n, arrivals_on_time as n_ok,
         arrivals_delayed as n_late, cancelled_count as n_odw, sum_arrival_delay_min as sum_op
  from m_arr where station_id = {STATION}
  union all
  select month, 'O', hour_id, departures_count, departures_on_time, departures_delayed, cancelled_count,
         sum_departure_delay_min
  from m_dep where station_id = {STATION})
select month, {MONTH_TXT} as month_txt, kierunek, z.hour_id, h.hour_label,
       cast(sum(n) as bigint) as n, cast(sum(n_ok) as bigint) as n_ok, cast(sum(n_late) as bigint) as n_late,
       cast(sum(n_odw) as bigint) as n_odw, cast(sum(sum_op) as bigint) as sum_op
from z join {HOURS} h on h.hour_id = z.hour_id
group by month, kierunek, z.hour_id, h.hour_label
"""

H11_SQL = _BOTH + f""",
z AS (
  select date_id, 'P' as kierunek, arrivals_count as n, arrivals_on_time as n_ok, arrivals_delayed as n_late,
         cancelled_count as n_odw, sum_arrival_delay_min as sum_op
  from f_arr where station_id = {STATION}
  union all
  select date_id, 'O', departures_count, departures_on_time, departures_delayed, cancelled_count,
         sum_departure_delay_min
  from f_dep where station_id = {STATION}),
zz AS (select z.*, strptime(cast(date_id as varchar), '%Y%m%d') as d from z)
select cast(year(d) * 100 + month(d) as bigint) as month, strftime(d, '%Y-%m') as month_txt, kierunek,
       isodow(d) as dzien_tyg,
       cast(sum(n) as bigint) as n, cast(sum(n_ok) as bigint) as n_ok, cast(sum(n_late) as bigint) as n_late,
       cast(sum(n_odw) as bigint) as n_odw, cast(sum(sum_op) as bigint) as sum_op,
       cast(count(distinct date_id) as bigint) as liczba_dni
from zz group by 1, 2, 3, 4
"""

H12_SQL = _BOTH_M + f""",
z AS (
  select month, 'P' as kierunek, from_station_id as stacja_id, arrivals_count as n, arrivals_on_time as n_ok,
         cancelled_count as n_odw, sum_arrival_delay_min as sum_op
  from m_arr where station_id = {STATION}
  union all
  select month, 'O', to_station_id, departures_count, departures_on_time, cancelled_count,
         sum_departure_delay_min
  from m_dep where station_id = {STATION})
select month, {MONTH_TXT} as month_txt, kierunek, stacja_id, s.name as stacja,
       cast(sum(n) as bigint) as n, cast(sum(n_ok) as bigint) as n_ok, cast(sum(n_odw) as bigint) as n_odw,
       cast(sum(sum_op) as bigint) as sum_op
from z join fx_station s on s.id = z.stacja_id
group by month, kierunek, stacja_id, s.name
"""

H13_SQL = DIS_BASE + DIS_CTES + f""",
z AS (select f.*, strptime(cast(date_id as varchar), '%Y%m%d') as d, c.description as cause_name
      from f_dis f join fx_cause c on c.code = f.cause_code where station_id = {STATION})
select cast(year(d) * 100 + month(d) as bigint) as month, strftime(d, '%Y-%m') as month_txt,
       isodow(d) as dzien_tyg, case when isodow(d) >= 6 then 'WE' else 'WD' end as day_type,
       cause_code,
       regexp_replace(cause_name, 'Na odcinku od stacji \\{{[^}}]*\\}} do stacji \\{{[^}}]*\\}}', 'Na części trasy')
         as przyczyna,
       cast(sum(occurrences_count) as bigint) as wystapienia, cast(sum(runs_count) as bigint) as kursy,
       cast(sum(runs_total_count) as bigint) as kursy_razem
from z group by 1, 2, 3, 4, 5, 6
"""

SQL = {
    "h5_punctuality_by_daytype_monthly": H5_SQL,
    "h6_status_share_monthly": H6_SQL,
    "h7_stop_hourly_monthly": H7_SQL,
    "h8_disruption_causes_monthly": H8_SQL,
    "h9_run_route": H9_SQL,
    "h10_station_hourly_monthly": H10_SQL,
    "h11_station_weekday_monthly": H11_SQL,
    "h12_station_directions_monthly": H12_SQL,
    "h13_station_disruptions_monthly": H13_SQL,
}

_ = DIS_KEYS_M
