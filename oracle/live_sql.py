"""DuckDB oracle SQL for the live layer: canonical JSON text is assembled by
hand (keys sorted, null/false dropped) and hashed with sha256."""

from __future__ import annotations

from oracle.fixtures_sql import cte

TS = "'%Y-%m-%d %H:%M:%S'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _str(k: str, v: str) -> str:
    return f"case when {v} is not null then '\"{k}\":' || to_json({v}) end"


def _num(k: str, v: str) -> str:
    return f"case when {v} is not null then '\"{k}\":' || cast({v} as varchar) end"


def _flag(k: str, v: str) -> str:
    return f"case when {v} then '\"{k}\":true' end"


def canon(*parts: str) -> str:
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


E3_SQL = f"""
WITH ev AS (select event_id, ts, user_id, event_type, cast(json_extract_string(props, '$.k') as integer) as k,
                   cast(ts as date) as day from events),
snap AS (select * from (select ev.*, row_number() over (partition by day, user_id order by ts desc, event_id desc) rn
                        from ev) where rn = 1),
s AS (select day, user_id, event_type, k // 50 as k_bucket, event_type = 'signup' as is_final,
             sha256({canon(_str('eventType', 'event_type'), _num('kBucket', 'k // 50'))}) as change_hash from snap)
select strftime(c.day, '%Y-%m-%d') as day, c.user_id, c.event_type, c.k_bucket, c.change_hash,
       case when p.user_id is null then 'new' else 'changed' end as diff_kind
from s c left join s p on p.user_id = c.user_id and p.day = c.day - 1
where p.user_id is null or (not p.is_final and p.change_hash <> c.change_hash)
"""

_DIS = cte("fx_disr0") + f""",
rows AS (select d.*, unnest(case when tax_pct = 5 then [operating_date] else [operating_date, operating_date + 1] end)
                as snapshot_day from fx_disr0 d),
r2 AS (select snapshot_day, cast(2001 as bigint) as schedule_id, l_orderkey as order_id, l_orderkey as train_order_id,
              operating_date, l_suppkey % 10 as dsta_id, l_linenumber as sequence_number, disruption_type_code,
              message || case when snapshot_day > operating_date then ' (aktualizacja)' else '' end as message,
              disruption_id from rows),
flat AS (select * from (select r2.*, row_number() over (partition by snapshot_day, schedule_id, order_id,
                        train_order_id, operating_date, dsta_id, sequence_number order by disruption_id desc) rn
                        from r2) where rn = 1),
fh AS (select *, sha256({canon(_str('disruptionTypeCode', 'disruption_type_code'), _str('message', 'message'))})
              as change_hash from flat),
hi AS (select max(snapshot_day) as hi from fh),
j AS (select c.*, p.snapshot_day as p_day, p.schedule_id as p_schedule_id, p.order_id as p_order_id,
             p.train_order_id as p_train_order_id, p.operating_date as p_operating_date, p.dsta_id as p_dsta_id,
             p.sequence_number as p_sequence_number, p.disruption_type_code as p_type, p.message as p_message,
             p.change_hash as p_hash
      from fh c full outer join (select * exclude (snapshot_day), snapshot_day + 1 as snapshot_day from fh) p
        on c.snapshot_day = p.snapshot_day and c.schedule_id = p.schedule_id and c.order_id = p.order_id
       and c.train_order_id = p.train_order_id and c.operating_date = p.operating_date and c.dsta_id = p.dsta_id
       and c.sequence_number = p.sequence_number),
ev AS (
  select snapshot_day, 'changed' as kind, schedule_id, order_id, train_order_id, operating_date, dsta_id,
         sequence_number, disruption_type_code, message, change_hash
  from j where change_hash is not null and (p_hash is null or p_hash <> change_hash)
  union all
  select p_day, 'ended', p_schedule_id, p_order_id, p_train_order_id, p_operating_date, p_dsta_id,
         p_sequence_number, p_type, p_message, null
  from j, hi where p_hash is not null and change_hash is null and p_day <= hi.hi
                and p_operating_date >= p_day)"""

E5_SQL = _DIS + """
select strftime(snapshot_day, '%Y-%m-%d') as snapshot_day, kind, schedule_id, order_id, train_order_id,
       strftime(operating_date, '%Y-%m-%d') as operating_date, dsta_id, sequence_number, disruption_type_code,
       message, change_hash
from ev"""

D15_SQL = _DIS + """,
e2 AS (select ev.*, case kind when 'changed' then 'C' else 'E' end as k2 from ev),
o AS (select e2.*,
             lag(change_hash) over w as prev_hash, lag(k2) over w as prev_kind,
             last_value(k2) over (w rows between unbounded preceding and unbounded following) as last_kind
      from e2 window w as (partition by operating_date, schedule_id, train_order_id, dsta_id, sequence_number
                           order by snapshot_day, k2)),
ins AS (select o.*, row_number() over (partition by operating_date, schedule_id, train_order_id, dsta_id,
                                       sequence_number order by snapshot_day desc) as newest
        from o where k2 = 'C' and change_hash is distinct from (case when prev_kind is null then null
                                                                     when prev_kind = 'C' then prev_hash end))
select strftime(operating_date, '%Y-%m-%d') as operating_date, schedule_id, train_order_id, dsta_id, sequence_number,
       order_id, disruption_type_code, message, change_hash, newest = 1 and last_kind = 'C' as is_active,
       strftime(snapshot_day, '%Y-%m-%d') || ' 06:00:00' as snapshot_ts
from ins"""

_TRACK = cte("fx_run", "fx_stop_raw") + f""",
x AS (select s.*, r.train_status, v.v,
             case when s.tax_pct = 1 then null else cast(s.l_quantity as integer) - 20 end as delay,
             r.operating_date
      from fx_stop_raw s join fx_run r on r.ophe_id = s.l_orderkey, (select unnest([1, 2]) as v) v),
y AS (select operating_date, cast(2001 as bigint) as schedule_id, l_orderkey as order_id, l_orderkey as train_order_id,
             l_suppkey % 10 as dsta_id, train_status, v,
             make_timestamp((cast(epoch(operating_date) as bigint) + (l_linenumber // 4) * 86400
                             + (l_partkey % 24) * 3600 + cast(l_quantity as integer) * 60
                             + coalesce(delay, 0) * 60 * (v - 1)) * 1000000) as act,
             tax_pct, case when v = 2 then delay end as arrival_delay_min,
             case when v = 2 then delay end as departure_delay_min,
             l_linestatus = 'F' as is_confirmed, l_returnflag = 'R' as is_cancelled,
             cast(actual_sequence as integer) as actual_sequence,
             make_timestamp((cast(epoch(operating_date) as bigint) + v * 6 * 3600) * 1000000) as snapshot_ts
      from x),
z AS (select *, case when tax_pct <> 0 then act end as actual_arrival,
             case when tax_pct <> 5 then act end as actual_departure from y),
h AS (select *, sha256({canon(_str('actualArrival', f"strftime(actual_arrival, {ISO})"),
                              _str('actualDeparture', f"strftime(actual_departure, {ISO})"),
                              _num('actualSequenceNumber', 'actual_sequence'),
                              _flag('isCancelled', 'is_cancelled'), _flag('isConfirmed', 'is_confirmed'),
                              _str('trainStatus', 'train_status'))}) as change_hash from z),
logd AS (select * from (select h.*, row_number() over (partition by operating_date, train_order_id, dsta_id,
                        change_hash order by snapshot_ts, schedule_id, order_id) rn from h) where rn = 1)"""

D14_SQL = _TRACK + f"""
select strftime(operating_date, '%Y-%m-%d') as operating_date, train_order_id, dsta_id, train_status,
       strftime(actual_arrival, {TS}) as actual_arrival, strftime(actual_departure, {TS}) as actual_departure,
       arrival_delay_min, is_confirmed, is_cancelled, change_hash, strftime(snapshot_ts, {TS}) as snapshot_ts
from logd"""

E12_SQL = _TRACK + f"""
select strftime(operating_date, '%Y-%m-%d') as operating_date, train_order_id, dsta_id,
       strftime(actual_arrival, {TS}) as actual_arrival, strftime(snapshot_ts, {TS}) as snapshot_ts
from (select logd.*, row_number() over (partition by operating_date, train_order_id, dsta_id
                                        order by snapshot_ts desc, actual_sequence desc) r2
      from logd where hour(actual_arrival) between 6 and 17) where r2 = 1"""

SQL = {
    "e3_run_diff": E3_SQL,
    "e5_disruption_diff": E5_SQL,
    "d15_disruption_tracking_log": D15_SQL,
    "d14_operation_tracking_log": D14_SQL,
    "e12_latest_versions": E12_SQL,
}


def _local(sec_ts: str) -> str:
    return f"timezone('Europe/Warsaw', timezone('UTC', {sec_ts}))"


_BOARD = _TRACK.replace(cte("fx_run", "fx_stop_raw"), cte("fx_run", "fx_stop_raw", "fx_disr0", "fx_plan",
                                                         "fx_station", "fx_cause") , 1) + _DIS.replace(
    cte("fx_disr0"), "", 1) + """,
e2 AS (select ev.*, case kind when 'changed' then 'C' else 'E' end as k2 from ev),
o AS (select e2.*,
             lag(change_hash) over w as prev_hash, lag(k2) over w as prev_kind,
             last_value(k2) over (w rows between unbounded preceding and unbounded following) as last_kind
      from e2 window w as (partition by operating_date, schedule_id, train_order_id, dsta_id, sequence_number
                           order by snapshot_day, k2)),
ins AS (select o.*, row_number() over (partition by operating_date, schedule_id, train_order_id, dsta_id,
                                       sequence_number order by snapshot_day desc) as newest
        from o where k2 = 'C' and change_hash is distinct from (case when prev_kind is null then null
                                                                     when prev_kind = 'C' then prev_hash end)),
dlog AS (select operating_date, schedule_id, train_order_id, dsta_id, sequence_number, order_id, disruption_type_code,
                message, newest = 1 and last_kind = 'C' as is_active,
                cast(snapshot_day as timestamp) + interval 6 hour as snapshot_ts from ins)"""


_BOARD_COMMON = _BOARD + f""",
ends AS (select schedule_id, order_id, min(order_number) as first_seq, max(order_number) as last_seq,
                arg_min(dsta_id, order_number) as sid_start, arg_max(dsta_id, order_number) as sid_end
         from fx_plan group by schedule_id, order_id),
ends2 AS (select e.*, a.name as station_start, b.name as station_end from ends e
          left join fx_station a on a.id = e.sid_start left join fx_station b on b.id = e.sid_end),
dt AS (select d.schedule_id, d.order_id, d.operating_date, d.dsta_id, d.snapshot_ts,
              replace(replace(coalesce(dc.description, d.message, d.disruption_type_code),
                              '{{stacja_poczatkowa}}', coalesce(e.station_start, '—')),
                      '{{stacja_koncowa}}', coalesce(e.station_end, '—')) as t
       from dlog d left join fx_cause dc on lower(dc.code) = lower(coalesce(d.message, d.disruption_type_code))
       left join ends2 e on e.schedule_id = d.schedule_id and e.order_id = d.order_id
       where d.is_active and {_local('d.snapshot_ts')} >= timestamp '2001-07-26 12:00:00'),
disr AS (select schedule_id, order_id, operating_date, dsta_id,
                string_agg(t, ' | ' order by snapshot_ts, t) as utrudnienia
         from dt where t is not null group by schedule_id, order_id, operating_date, dsta_id)"""


def _board_rank(col: str) -> str:
    return f"""lr AS (select * from (select logd.*, row_number() over (partition by operating_date, train_order_id, dsta_id
                                     order by snapshot_ts desc, actual_sequence desc) as rn3
                      from logd where dsta_id = 3 and operating_date >= date '2001-07-26'
                       and {_local(col)} between timestamp '2001-07-27 11:55:00' and timestamp '2001-07-27 20:00:00')
       where rn3 = 1)"""


_NOW = "timestamp '2001-07-27 12:00:00'"
_BOARD_TAIL = """
from lr l
join fx_run r on r.operating_date = l.operating_date and r.schedule_id = l.schedule_id and r.order_id = l.order_id
             and r.train_order_id = l.train_order_id
join fx_plan sd on sd.schedule_id = l.schedule_id and sd.order_id = l.order_id and sd.dsta_id = l.dsta_id
left join ends2 e on e.schedule_id = sd.schedule_id and e.order_id = sd.order_id
left join vias v on v.schedule_id = sd.schedule_id and v.order_id = sd.order_id
left join disr dr on dr.operating_date = l.operating_date and dr.schedule_id = l.schedule_id
                 and dr.order_id = l.order_id and dr.dsta_id = l.dsta_id"""

_COMMON_COLS = """r.carrier_code as przewoznik, r.category_code as kategoria,
       'Pociag ' || cast(r.order_id as varchar) as nazwa_pociagu, cast(r.order_id as varchar) as nr_pociagu,
       e.station_start as stacja_poczatkowa, e.station_end as stacja_koncowa, v.stacje_posrednie,
       sd.departure_platform as peron, sd.departure_track as tor"""

H14_SQL = _BOARD_COMMON + f""",
{_board_rank('l2.actual_departure').replace('logd where', 'logd l2 where').replace('select logd.*', 'select l2.*')},
vias AS (select sd.schedule_id, sd.order_id, string_agg(st.name, ', ' order by sd2.order_number) as stacje_posrednie
         from fx_plan sd join fx_plan sd2 on sd2.schedule_id = sd.schedule_id and sd2.order_id = sd.order_id
                                          and sd2.order_number > sd.order_number
         join ends e on e.schedule_id = sd.schedule_id and e.order_id = sd.order_id and sd2.order_number < e.last_seq
         left join fx_station st on st.id = sd2.dsta_id
         where sd.dsta_id = 3 group by sd.schedule_id, sd.order_id)
select strftime(l.operating_date + coalesce(sd.departure_day, 0), '%Y-%m-%d') as planowy_odjazd_dzien,
       sd.departure_time as planowy_odjazd_godzina, sd.arrival_time as planowy_przyjazd_godzina,
       {_COMMON_COLS},
       l.departure_delay_min as opoznienie_min,
       case when l.is_cancelled then 'ODWOŁANY' when {_local('l.actual_departure')} <= {_NOW} then 'ODJECHAŁ'
            when l.departure_delay_min > 5 then 'OPÓŹNIONY' else 'PLANOWY' end as status,
       cast(round((epoch({_local('l.actual_departure')}) - epoch({_NOW})) / 60.0) as bigint) as do_odjazdu_min,
       strftime({_local('l.actual_departure')}, {TS}) as faktyczny_odjazd, dr.utrudnienia
{_BOARD_TAIL}
where sd.departure_time is not null"""

H15_SQL = _BOARD_COMMON + f""",
{_board_rank('l2.actual_arrival').replace('logd where', 'logd l2 where').replace('select logd.*', 'select l2.*')},
vias AS (select sd.schedule_id, sd.order_id, string_agg(st.name, ', ' order by sd2.order_number) as stacje_posrednie
         from fx_plan sd join fx_plan sd2 on sd2.schedule_id = sd.schedule_id and sd2.order_id = sd.order_id
                                          and sd2.order_number < sd.order_number
         join ends e on e.schedule_id = sd.schedule_id and e.order_id = sd.order_id and sd2.order_number > e.first_seq
         left join fx_station st on st.id = sd2.dsta_id
         where sd.dsta_id = 3 group by sd.schedule_id, sd.order_id)
select strftime(l.operating_date + coalesce(sd.arrival_day, 0), '%Y-%m-%d') as planowy_przyjazd_dzien,
       sd.arrival_time as planowy_przyjazd_godzina,
       {_COMMON_COLS},
       l.arrival_delay_min as opoznienie_przyjazd_min,
       case when l.is_cancelled then 'ODWOŁANY' when {_local('l.actual_departure')} <= {_NOW} then 'ODJECHAŁ'
            when {_local('l.actual_arrival')} <= {_NOW} then 'PRZYJECHAŁ'
            when l.arrival_delay_min > 5 then 'OPÓŹNIONY' else 'PLANOWY' end as status,
       cast(round((epoch({_local('l.actual_arrival')}) - epoch({_NOW})) / 60.0) as bigint) as do_przyjazdu_min,
       strftime({_local('l.actual_arrival')}, {TS}) as faktyczny_przyjazd,
       case when e.sid_end = l.dsta_id then null
            else strftime(l.operating_date + coalesce(sd.departure_day, 0), '%Y-%m-%d') end as planowy_odjazd_dzien,
       case when e.sid_end = l.dsta_id then null else sd.departure_time end as planowy_odjazd_godzina,
       l.departure_delay_min as opoznienie_odjazdu_min,
       cast(round((epoch({_local('l.actual_departure')}) - epoch({_NOW})) / 60.0) as bigint) as do_odjazdu_min,
       strftime({_local('l.actual_departure')}, {TS}) as faktyczny_odjazd, dr.utrudnienia
{_BOARD_TAIL}
where sd.arrival_time is not null"""

SQL["h14_departures_board"] = H14_SQL
SQL["h15_arrivals_board"] = H15_SQL

E1_CANON = canon(_str('actualArrival', f"strftime(actual_arrival, {ISO})"),
                 _str('actualDeparture', f"strftime(actual_departure, {ISO})"),
                 _num('actualSequenceNumber', 'actual_sequence'),
                 _flag('isCancelled', 'is_cancelled'), _flag('isConfirmed', 'is_confirmed'),
                 _str('trainStatus', 'train_status'))

E1_SQL = _TRACK + f"""
select strftime(snapshot_ts, {TS}) as snapshot_ts, train_order_id, actual_sequence, {E1_CANON} as canonical,
       change_hash
from h"""

E2_SQL = cte("fx_run", "fx_stop") + f"""
, pick AS (select r.order_id,
                  coalesce(min(case when s.dsta_id = 3 then s.actual_sequence end), min(s.actual_sequence)) as q
           from fx_run r left join fx_stop s on s.ophe_id = r.ophe_id group by r.order_id)
select p.order_id, s.dsta_id as station_id, s.actual_sequence,
       strftime(make_timestamp(s.arr_sec * 1000000), {ISO}) as actual_arrival
from pick p left join fx_stop s on s.ophe_id = p.order_id and s.actual_sequence = p.q"""

SQL["e1_change_hash"] = E1_SQL
SQL["e2_station_projection"] = E2_SQL

SQL["b7_live_delta_rows"] = E5_SQL

# The streamed feed by its rule: two fetches a date, faults by the day number modulo 5 (see payloads.live_pages).
_FETCHED = cte("fx_run", "fx_stop") + """
, days AS (select operating_date, count(*) as n, date_diff('day', date '1970-01-01', operating_date) % 5 as k,
                  max(order_id // 200) + 1 as pages from fx_run group by operating_date)
, fetched AS (
  select operating_date + 1 as day, '05' as hour, n, case when k < 2 then 'ERR' else 'OK' end as outcome,
         case k when 0 then 'page ' || pages || ': not a JSON object' when 1 then 'pages missing' end as error, '05' as stamp, k from days
  union all
  select operating_date + 1, '06', n, case when k < 2 then 'OK' when k = 2 then 'STALE' else 'EMPTY' end, null,
         case when k = 2 then '04' else '06' end, k from days)"""

SQL["e9_operations_stream"] = _FETCHED + """
select strftime(day, '%Y%m%d') || hour || '0000' as run_ts, 'operations' as feed, outcome,
       case when outcome = 'OK' then n else 0 end as delta_count, strftime(day, '%Y-%m-%d') || 'T' || stamp || ':00:00Z' as generated_at,
       cast(epoch(timestamp '2001-08-02 12:00:00') - epoch(day) - cast(stamp as integer) * 3600 as bigint) as lag_seconds, error
from fetched"""

SQL["e9_tracking_log"] = _FETCHED + """
select distinct strftime(r.operating_date, '%Y-%m-%d') as operating_date, r.train_order_id, s.dsta_id, r.train_status,
       strftime(f.day, '%Y-%m-%d') || ' ' || f.hour || ':00:00' as snapshot_ts
from fx_run r join fx_stop s on s.ophe_id = r.ophe_id join fetched f on f.day = r.operating_date + 1 and f.outcome = 'OK'"""
