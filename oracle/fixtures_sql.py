"""DuckDB twins of ``perron.sources.fixtures`` as CTE fragments.

``cte("fx_plan", "fx_stop")`` returns a ``WITH`` clause holding the named
adapters and everything they depend on, in dependency order.
"""

from __future__ import annotations

_BASE = "date '2001-07-23'"
_FACTOR = "10000000000"

FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_run": ((), f"""
        select o.o_orderkey as ophe_id,
               {_BASE} + cast(o.o_orderkey % 10 as integer) as operating_date,
               cast(2001 as bigint) as schedule_id,
               o.o_orderkey as order_id,
               o.o_orderkey as train_order_id,
               case o.o_orderstatus when 'F' then 'C' when 'O' then 'X' when 'P' then 'Q' end as train_status,
               case when o.o_orderkey % 11 = 0 then 'A/B'
                    when substr(o.o_orderpriority,1,1) = '1' then 'A'
                    when substr(o.o_orderpriority,1,1) in ('2','3') then 'B'
                    else 'C' end as category_code,
               case when c.c_mktsegment = 'BUILDING' then 'K1' else 'K2' end as carrier_code
        from orders o join customer c on o.o_custkey = c.c_custkey"""),
    "fx_stop_raw": ((), """
        select l.*,
               cast(round(l_tax * 100) as integer) as tax_pct,
               row_number() over (partition by l_orderkey
                                  order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as actual_sequence
        from lineitem l"""),
    "fx_plan0": (("fx_stop_raw",), """
        select * from (
            select s.*, row_number() over (partition by l_orderkey, l_linenumber
                                           order by l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn_plan
            from fx_stop_raw s) where rn_plan = 1"""),
    "fx_plan": (("fx_plan0",), """
        select cast(2001 as bigint) as schedule_id, order_id, order_number, dsta_id,
               case when not is_first then clock end as arrival_time,
               case when not is_first then dday end as arrival_day,
               case when not is_first then platform end as arrival_platform,
               case when not is_first then track end as arrival_track,
               case when not is_first then category end as arrival_category,
               case when not is_first then number end as arrival_train_no,
               case when not is_last then clock end as departure_time,
               case when not is_last then dday end as departure_day,
               case when not is_last then platform end as departure_platform,
               case when not is_last then track end as departure_track,
               case when not is_last then category end as departure_category,
               case when not is_last then number end as departure_train_no,
               dstty_id
        from (
            select l_orderkey as order_id, l_linenumber as order_number, l_suppkey % 10 as dsta_id,
                   lpad(cast(l_partkey % 24 as varchar), 2, '0') || ':' ||
                   lpad(cast(cast(l_quantity as integer) as varchar), 2, '0') || ':00' as clock,
                   cast(l_linenumber // 4 as integer) as dday,
                   case when tax_pct = 6 then 'IV'
                        else cast(l_suppkey % 8 + 1 as varchar) || case when l_partkey % 5 = 0 then 'a' else '' end
                   end as platform,
                   cast(l_partkey % 12 + 1 as varchar) as track,
                   case l_partkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' end as category,
                   case when l_suppkey % 3 <> 0
                        then cast(l_orderkey as varchar) || '/' || cast(l_suppkey % 5 as varchar) end as number,
                   case when cast(round(l_discount * 100) as integer) = 0 then 2 else 1 end as dstty_id,
                   l_linenumber = min(l_linenumber) over (partition by l_orderkey) as is_first,
                   l_linenumber = max(l_linenumber) over (partition by l_orderkey) as is_last
            from fx_plan0)"""),
    "fx_stop": (("fx_stop_raw",), f"""
        select l_orderkey as ophe_id, cast(actual_sequence as integer) as actual_sequence,
               l_linenumber as planned_sequence, l_suppkey % 10 as dsta_id,
               case when tax_pct <> 0 then act_sec end as arr_sec,
               case when tax_pct <> 5 then act_sec end as dep_sec,
               l_linestatus = 'F' as is_confirmed,
               l_returnflag = 'R' as is_cancelled,
               delay as arrival_delay_min, delay as departure_delay_min
        from (
            select s.*,
                   case when tax_pct = 1 then null else cast(l_quantity as integer) - 20 end as delay,
                   cast(epoch({_BASE} + cast(l_orderkey % 10 as integer)) as bigint)
                     + (l_linenumber // 4) * 86400 + (l_partkey % 24) * 3600 + cast(l_quantity as integer) * 60
                     + coalesce(case when tax_pct = 1 then null else cast(l_quantity as integer) - 20 end, 0) * 60
                     as act_sec
            from fx_stop_raw s)"""),
    "fx_disr0": (("fx_stop_raw",), f"""
        select s.l_orderkey * 100 + s.actual_sequence as disruption_id,
               {_BASE} + cast(s.l_orderkey % 10 as integer) as operating_date,
               s.l_orderkey, s.l_linenumber, s.l_suppkey, s.tax_pct,
               case when s.tax_pct = 2 then null when s.tax_pct = 4 then 'ZZ' else p.p_type end as disruption_type_code,
               case when s.tax_pct = 2 then p.p_type
                    when s.tax_pct = 3 then 'Utrudnienia w ruchu'
                    else 'Komunikat ' || cast(s.l_orderkey as varchar) end as message
        from fx_stop_raw s join part p on s.l_partkey = p.p_partkey
        where s.l_returnflag = 'R'"""),
    "fx_dis_header": (("fx_disr0",), f"""
        select cast(strftime(operating_date, '%Y%m%d') as bigint) * {_FACTOR} + disruption_id as id,
               disruption_type_code, message,
               cast(operating_date as timestamp) + interval 8 hour as snapshot_ts
        from fx_disr0"""),
    "fx_dis_details": (("fx_disr0",), f"""
        select operating_date, cast(2001 as bigint) as schedule_id, l_orderkey as order_id,
               l_orderkey as train_order_id, l_suppkey % 10 as dsta_id, l_linenumber as sequence_number,
               cast(strftime(operating_date, '%Y%m%d') as bigint) * {_FACTOR} + disruption_id as dihe_id
        from fx_disr0"""),
    "fx_cause": ((), """
        select p_type as code,
               'Utrudnienie (' || lower(p_type) || '). Na odcinku od stacji {stacja_poczatkowa} do stacji {stacja_koncowa}' as description
        from (select distinct p_type from part)"""),
    "fx_carrier": ((), """
        select * from (values
            ('K1', 'Przewoznik Pierwszy', date '2001-07-25', date '2001-07-28'),
            ('K1', 'Przewoznik Pierwszy SA', date '2001-07-29', date '2999-12-31'),
            ('K2', 'Przewoznik Drugi', date '2001-07-25', date '2001-07-28'),
            ('K2', 'Przewoznik Drugi SA', date '2001-07-29', date '2999-12-31')
        ) t(code, name, valid_from, valid_to)"""),
    "fx_category": ((), """
        select * from (values
            ('A', 'K1', 'Ekspres', 'E'), ('B', 'K1', 'Pospieszny', 'P'), ('C', 'K1', 'Osobowy', 'O'),
            ('A', 'K2', 'Ekspres', 'E'), ('B', 'K2', 'Pospieszny', 'P'), ('C', 'K2', 'Osobowy', 'O')
        ) t(code, carrier_code, name, speed_category_code)"""),
    "fx_status": (("fx_run",), """
        select code, case code when 'C' then 'Zrealizowany' when 'X' then 'Odwolany' when 'Q' then 'Skrocony' end as name
        from (select distinct train_status as code from fx_run)"""),
    "fx_station": ((), """
        select s_suppkey as id, s_name as name, cast(s_nationkey as bigint) as dcit_id from supplier"""),
    "fx_city": ((), """
        select cast(n_nationkey as bigint) as id, n_name as name from nation"""),
    # d_train_type with both version lookups resolved per (category, carrier, date) elsewhere
    "fx_train_type": (("fx_category", "fx_carrier", "fx_run"), """
        select cc.code as category_code, cc.name as category_name, cc.speed_category_code,
               ca.code as carrier_code, ca.name as carrier_name, ca.valid_from, ca.valid_to
        from fx_category cc join fx_carrier ca on ca.code = cc.carrier_code
        union all
        select x.category_code,
               coalesce(p1.name, split_part(x.category_code, '/', 1)) || ' / ' ||
               coalesce(p2.name, split_part(x.category_code, '/', 2)) as category_name,
               p1.speed_category_code, ca.code, ca.name, ca.valid_from, ca.valid_to
        from (select distinct category_code, carrier_code from fx_run r
              where strpos(category_code, '/') > 0
                and not exists (select 1 from fx_category cc
                                where cc.code = r.category_code and cc.carrier_code = r.carrier_code)) x
        join fx_carrier ca on ca.code = x.carrier_code
        left join fx_category p1 on p1.code = split_part(x.category_code, '/', 1) and p1.carrier_code = x.carrier_code
        left join fx_category p2 on p2.code = split_part(x.category_code, '/', 2) and p2.carrier_code = x.carrier_code"""),
    "fx_ends": (("fx_plan",), """
        select schedule_id, order_id,
               min(order_number) as min_on, max(order_number) as max_on,
               arg_min(dsta_id, order_number) as from_station_id,
               arg_max(dsta_id, order_number) as to_station_id,
               arg_min_null(departure_time, order_number) as dep_time,
               arg_min_null(departure_day, order_number) as dep_day,
               arg_max_null(arrival_time, order_number) as arr_time,
               arg_max_null(arrival_day, order_number) as arr_day
        from fx_plan group by schedule_id, order_id"""),
}


def cte(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in FRAGMENTS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n][1]})" for n in order) + "\n"
