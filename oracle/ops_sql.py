"""DuckDB oracle SQL for the step report (H25) and the heartbeat log."""

from __future__ import annotations

from oracle.live_sql import E3_SQL

H25_SQL = """
WITH st AS (select cast(strftime(ts, '%Y%m%d') as bigint) as pipeline_run_id, event_type as step_name,
                   min(ts) as start_time, max(ts) as end_time,
                   case when max(case when value < 1 then 1 else 0 end) = 1 then 'FAILED' else 'SUCCESS' end as status
            from events group by 1, 2),
x AS (select *, case when start_time is not null and end_time is not null then
              cast(sign(epoch_us(end_time) - epoch_us(start_time))
                   * ((abs(epoch_us(end_time) - epoch_us(start_time)) + 50000) // 100000) as bigint) / 10.0
              end as seconds
      from st where step_name <> 'send_report')
select pipeline_run_id, step_name, status, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') as start_time,
       strftime(end_time, '%Y-%m-%d %H:%M:%S.%f') as end_time, seconds, 0 as is_total from x
union all
select pipeline_run_id, 'RAZEM', null, null, null, round(coalesce(sum(seconds), 0.0), 1), 1 from x
group by pipeline_run_id"""

E11_SQL = E3_SQL.replace("\nselect strftime(c.day, '%Y-%m-%d') as day,", "\n, diff AS (select c.day,", 1).rstrip() \
    + """),
n AS (select day, count(*) as delta_count from diff group by day),
evd AS (select cast(ts as date) as day, max(ts) as last_ts from events group by 1),
cyc AS (select strftime(evd.day, '%Y%m%d') as run_ts, strftime(last_ts, '%Y-%m-%d %H:%M:%S') as generated_at,
               cast(coalesce(n.delta_count, 0) as bigint) as delta_count,
               cast(epoch(evd.day + 1) as bigint) - cast(epoch(strptime(strftime(last_ts, '%Y-%m-%d %H:%M:%S'),
                                                                       '%Y-%m-%d %H:%M:%S')) as bigint) as lag_seconds
        from evd left join n on n.day = evd.day)
select run_ts, 'users' as feed, case when delta_count = 0 then 'EMPTY' else 'OK' end as outcome, delta_count,
       generated_at, lag_seconds
from cyc"""

SQL = {"h25_step_report": H25_SQL, "e11_heartbeat_log": E11_SQL}
