"""Silver report views around one station and the route plans.

The station is a parameter (the reference hard-codes one station id).
Plan ends, names and executed entries are grouped aggregates joined once;
a match by either of two ids is one equi join on exploded ids or a union of
two equi joins plus a dedup.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.functions.clock import clock_seconds, date_epoch_seconds
from perron.functions.ordered import keep_last_max
from perron.plans.gold_dims import plan_ends
from perron.plans.gold_facts import train_types
from perron.plans.reports import SECTION_TEMPLATE, SECTION_TEXT
from perron.plans.silver_model import Silver

TS = "yyyy-MM-dd HH:mm:ss"
HDR = ["operating_date", "schedule_id", "order_id", "train_order_id"]


def _instant(day_col: str, t_col: str) -> F.Column:
    return F.when(F.col(t_col).isNotNull(),
                  date_epoch_seconds(F.col("operating_date")) + F.coalesce(F.col(day_col), F.lit(0)) * 86400
                  + clock_seconds(F.col(t_col)))


PLAN = ["schedule_id", "order_id"]


def _days(lo: dt.date, hi: dt.date) -> F.Column:
    return F.col("operating_date").between(F.lit(lo), F.lit(hi))


def _runs_calling(s: Silver, lo: dt.date, hi: dt.date, station_id) -> DataFrame:
    """Executed runs of the days whose plan calls at the station."""
    calling = s.schedule_details.where(F.col("dsta_id") == station_id).select(*PLAN)
    runs = s.operation_header.where(_days(lo, hi)).select(F.col("id").alias("ophe_id"), *HDR, "train_status")
    return runs.join(calling, PLAN, "left_semi")


def _labelled(s: Silver, runs: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """The runs that have a timetable entry, with its labels."""
    labels = s.schedule_header.where(_days(lo, hi)).select(
        *HDR, F.col("carrier_code").alias("przewoznik"), F.col("category_code").alias("kategoria"),
        F.col("national_number").alias("nr_pociagu"), F.col("name").alias("nazwa_pociagu"))
    return runs.join(labels, HDR)


def _station_name(s: Silver, df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    names = s.def_station.select(F.col("id").alias(id_col), F.col("name").alias(name_col))
    return df.join(names, id_col, "left")


def _carrier_and_category(s: Silver, df: DataFrame) -> DataFrame:
    """The carrier's name on the operating date (one row per date and carrier) and the category's name."""
    valid = s.def_carrier.select(F.col("code").alias("przewoznik"), "name", "valid_from", "valid_to")
    named = (df.select("operating_date", "przewoznik").distinct().join(valid, "przewoznik")
             .where(F.col("operating_date").between(F.col("valid_from"), F.col("valid_to")))
             .groupBy("operating_date", "przewoznik")
             .agg(keep_last_max([F.col("valid_from")], "name").alias("przewoznik_nazwa")))
    return _category(s, df.join(named, ["operating_date", "przewoznik"], "left"))


def _category(s: Silver, df: DataFrame) -> DataFrame:
    names = s.def_commercial_category.select(F.col("code").alias("kategoria"), F.col("carrier_code").alias("przewoznik"),
                                             F.col("name").alias("kategoria_nazwa"))
    return df.join(names, ["kategoria", "przewoznik"], "left")


def _stops_of(s: Silver, runs: DataFrame) -> DataFrame:
    return s.schedule_details.join(runs.select(*PLAN).distinct(), PLAN, "left_semi")


def _role(at: str, first: str, last: str) -> dict[str, F.Column]:
    start, end = F.col(at) == F.col(first), F.col(at) == F.col(last)
    return {"czy_start": start, "czy_koniec": end, "czy_przelot": ~start & ~end}


def _flag(c: F.Column, name: str) -> F.Column:
    return F.when(c, 1).otherwise(0).alias(name)


def _clock(c: F.Column, name: str) -> F.Column:
    return F.date_format(c, TS).alias(name)


def station_calls(s: Silver, as_of: dt.date, station_id) -> DataFrame:
    """H23 calls of runs at the station, D-7..D-1 by call day (runs from D-8).

    The call's plan position is matched with the earliest executed entry of that position.
    """
    lo, hi = as_of - dt.timedelta(days=8), as_of - dt.timedelta(days=1)
    runs = _labelled(s, _runs_calling(s, lo, hi, station_id), lo, hi)
    at = s.schedule_details.where(F.col("dsta_id") == station_id).select(
        *PLAN, "order_number", "arrival_time", "arrival_day", "departure_time", "departure_day")
    calls = runs.join(at, PLAN).select(
        *runs.columns, "order_number", _instant("arrival_day", "arrival_time").alias("due_in"),
        _instant("departure_day", "departure_time").alias("due_out"))
    calls = calls.withColumn("data_wro", F.to_date(F.timestamp_seconds(F.coalesce("due_in", "due_out")))).where(
        F.col("data_wro").between(F.lit(as_of - dt.timedelta(days=7)), F.lit(hi)))
    ends = plan_ends(_stops_of(s, runs)).select(
        *PLAN, "min_on", "max_on", F.col("from_station_id").alias("stacja_pocz_id"),
        F.col("to_station_id").alias("stacja_konc_id"))
    entry = F.struct("actual_arrival", "actual_departure", "arrival_delay_min", "departure_delay_min", "is_confirmed",
                     "is_cancelled")
    wanted = calls.select("ophe_id", "order_number").distinct()
    done = (s.operation_details.where(_days(lo, hi)).withColumnRenamed("planned_sequence", "order_number")
            .join(wanted, ["ophe_id", "order_number"], "left_semi")
            .groupBy("ophe_id", "order_number").agg(F.min_by(entry, "actual_sequence").alias("e"))
            .select("ophe_id", "order_number", "e.*"))
    x = calls.join(ends, PLAN, "left").join(done, ["ophe_id", "order_number"], "left")
    x = _station_name(s, _station_name(s, x, "stacja_pocz_id", "stacja_pocz"), "stacja_konc_id", "stacja_konc")
    x = _carrier_and_category(s, x)
    # disrupted here: the run's order id or its train id is among the station's affected ones
    hit = s.disruption_details.where(_days(lo, hi) & (F.col("dsta_id") == station_id)).select(
        "operating_date", "schedule_id", "order_id", "train_order_id")
    for mark, of in (("by_order", "order_id"), ("by_train", "train_order_id")):
        key = ["operating_date", "schedule_id", of]
        x = x.join(hit.select(*key).distinct().withColumn(mark, F.lit(True)), key, "left")

    def late(delay: str, actual: str, due: str) -> F.Column:
        own = F.round((F.unix_timestamp(actual) - F.col(due)) / 60.0).cast("bigint")
        return F.when(F.col(actual).isNotNull(), F.coalesce(F.col(delay).cast("bigint"), own))

    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("data_kursu"),
        F.date_format("data_wro", "yyyy-MM-dd").alias("data_wro"),
        "ophe_id", "schedule_id", "order_id", "train_order_id", "przewoznik", "przewoznik_nazwa", "kategoria",
        "kategoria_nazwa", "nr_pociagu", "nazwa_pociagu", "stacja_pocz_id", "stacja_pocz", "stacja_konc_id",
        "stacja_konc", *(_flag(c, name) for name, c in _role("order_number", "min_on", "max_on").items()),
        _clock(F.timestamp_seconds("due_in"), "plan_przyjazd"), _clock(F.col("actual_arrival"), "rz_przyjazd"),
        late("arrival_delay_min", "actual_arrival", "due_in").alias("op_przyjazd_min"),
        _clock(F.timestamp_seconds("due_out"), "plan_odjazd"), _clock(F.col("actual_departure"), "rz_odjazd"),
        late("departure_delay_min", "actual_departure", "due_out").alias("op_odjazd_min"),
        "train_status", _flag((F.col("train_status") == "X") | F.col("is_cancelled"), "czy_odwolany"),
        _flag(F.col("is_confirmed"), "czy_potwierdzony"),
        _flag(F.coalesce("by_order", "by_train"), "czy_utrudnienie"))


H24_GROUP = ["data_kursu", "data_wro", "ophe_id", "przewoznik", "kategoria", "nr_pociagu", "nazwa_pociagu",
             "stacja_pocz", "stacja_konc", "czy_start", "czy_koniec", "czy_przelot", "plan_przyjazd", "plan_odjazd",
             "op_przyjazd_min", "op_odjazd_min", "czy_odwolany", "przyczyna_kod", "przyczyna"]


def station_disruptions(s: Silver, calls: DataFrame, station_id) -> DataFrame:
    """H24 one row per run call and cause at the station.

    Cause code: the type code if it is in the dictionary, else the trimmed
    message if that is a code; text: the description with the section
    template replaced, else the message, else 'Nieokreślona'. The message
    is shown only when it is not itself a code; per run and cause the
    newest message and the first report time are kept.
    """
    # a call's reports bear its order or its train order: one equi join on a call's two numbers
    day = F.col("data_kursu").cast("date")
    numbers = lambda: F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("number")) for k, c in ((1, "order_id"), (2, "train_order_id"))])).alias("n")
    first, last = calls.select(F.min(day)).scalar(), calls.select(F.max(day)).scalar()
    told = (s.disruption_details.filter((F.col("dsta_id") == station_id) & F.col("operating_date").between(first, last))
            .select(F.date_format("operating_date", "yyyy-MM-dd").alias("data_kursu"), "schedule_id", numbers(), "dihe_id")
            .select("data_kursu", "schedule_id", "n.*", "dihe_id").distinct())
    mine = calls.select(*H24_GROUP[:-2], "schedule_id", numbers()).select(*H24_GROUP[:-2], "schedule_id", "n.*")
    pairs = mine.join(told, ["data_kursu", "schedule_id", "kind", "number"]).drop("kind", "number").distinct()
    # what each header says, by its rule
    known = s.def_disruption_cause.select(F.col("code").alias("przyczyna_kod"), F.regexp_replace("description", SECTION_TEMPLATE, SECTION_TEXT).alias("told"))
    said = s.disruption_header.select(F.col("id").alias("dihe_id"), "disruption_type_code", "message", F.trim("message").alias("words"), "snapshot_ts")
    said = (said.join(known.toDF("by_type", "type_text"), F.col("disruption_type_code") == F.col("by_type"), "left")
            .join(known.toDF("by_words", "words_text"), F.col("words") == F.col("by_words"), "left"))
    said = said.select("dihe_id", "snapshot_ts", F.coalesce("by_type", "by_words").alias("przyczyna_kod"),
                       F.coalesce(F.when(F.col("by_type").isNotNull(), F.col("type_text")).when(F.col("by_words").isNotNull(), F.col("words_text")).otherwise(F.col("message")),
                                  F.lit("Nieokreślona")).alias("przyczyna"), F.when(F.col("by_words").isNull(), F.col("message")).alias("komunikat"))
    return pairs.join(said, "dihe_id").groupBy(*H24_GROUP).agg(
        keep_last_max([F.col("snapshot_ts")], "komunikat").alias("komunikat"), F.date_format(F.min("snapshot_ts"), TS).alias("pierwsze_zgl"))


def route_start_monthly(s: Silver, as_of: dt.date, months: int = 24) -> DataFrame:
    """H22 origin departure delay per month, route, category and carrier.

    Counted: run not cancelled (X), confirmed stop at the plan's first
    position, station = route origin, plan's last station = route
    destination (route from the route dimension), train type version valid
    on the day (no fallback); a missing delay counts 0. All months, routes
    and categories in one aggregation (no month x route cross join).
    """
    m0 = as_of.year * 12 + as_of.month - 1 - (months - 1)      # first month of the window
    first_month = dt.date(m0 // 12, m0 % 12 + 1, 1)
    nxt = (as_of.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    oh = s.operation_header.filter(F.col("operating_date").between(F.lit(first_month), F.lit(nxt - dt.timedelta(days=1)))
                                   & (F.col("train_status") != "X")).select(F.col("id").alias("ophe_id"), *HDR)
    sh = s.schedule_header.select(*HDR, "category_code", "carrier_code")
    r = oh.join(sh, HDR, "inner")
    ends = plan_ends(s.schedule_details).select("schedule_id", "order_id", "min_on",
                                                F.col("to_station_id").alias("to_station_id"))
    od = s.operation_details.filter(F.col("is_confirmed") & F.col("operating_date").between(
        F.lit(first_month), F.lit(nxt - dt.timedelta(days=1)))).select(
        "ophe_id", "planned_sequence", F.col("dsta_id").alias("from_station_id"), "departure_delay_min")
    x = r.join(ends, ["schedule_id", "order_id"], "inner").join(od, "ophe_id", "inner").filter(
        F.col("planned_sequence") == F.col("min_on"))
    routes = plan_ends(s.schedule_details).select("from_station_id", "to_station_id").distinct()
    x = x.join(routes, ["from_station_id", "to_station_id"], "left_semi")
    tt = train_types(s).select("category_code", "carrier_code", "valid_from", "valid_to", "category_name",
                               "carrier_name")
    x = x.join(tt, ["category_code", "carrier_code"], "inner").filter(
        F.col("operating_date").between(F.col("valid_from"), F.col("valid_to")))
    return x.groupBy((F.year("operating_date") * 100 + F.month("operating_date")).cast("bigint").alias("month"),
                     "from_station_id", "to_station_id", "category_name", "carrier_name").agg(
        F.sum(F.coalesce("departure_delay_min", F.lit(0))).cast("bigint").alias("suma_op_start"),
        F.count(F.lit(1)).cast("bigint").alias("liczba_start"))


def _clock_day_minutes(t: str, d: str) -> F.Column:
    return F.when(F.col(t).isNotNull(), F.coalesce(F.col(d), F.lit(0)) * 86400 + clock_seconds(F.col(t)))


def completed_runs(s: Silver, as_of: dt.date, station_id) -> DataFrame:
    """H18 completed runs D-7..D-1 whose plan calls at the station.

    A plan folds to its two end stops and its call here (the largest values, should it call twice), a run to four
    executed entries: the first, the furthest reached (confirmed and not cancelled), and the latest at the plan's end
    and at the call. An entry that there is not stays null, and so does what is shown of it.
    """
    lo, hi = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=1)
    runs = _labelled(s, _runs_calling(s, lo, hi, station_id), lo, hi)
    times = ["arrival_time", "arrival_day", "departure_time", "departure_day"]
    stop = F.struct("order_number", "dsta_id", *times)
    call = F.when(F.col("dsta_id") == station_id, F.struct("order_number", *times))
    plans = _stops_of(s, runs).groupBy(*PLAN).agg(
        F.min_by(stop, "order_number").alias("origin"), F.max_by(stop, "order_number").alias("target"),
        F.struct(*(F.max(call[c]).alias(c) for c in ("order_number", *times))).alias("call"))
    runs = runs.join(plans, PLAN)
    spots = runs.select("ophe_id", F.col("target.order_number").alias("end_at"), F.col("call.order_number").alias("call_at"))
    entries = s.operation_details.where(_days(lo, hi)).drop("operating_date").join(spots, "ophe_id")
    reached = F.col("is_confirmed") & ~F.col("is_cancelled")
    entry = F.struct("dsta_id", "actual_arrival", "actual_departure", "arrival_delay_min", "departure_delay_min",
                     F.coalesce(F.col("is_cancelled"), F.lit(False)).alias("cancelled"),
                     F.coalesce(reached, F.lit(False)).alias("reached"))

    def latest(cond: F.Column) -> F.Column:
        return F.max_by(entry, F.when(cond, F.col("actual_sequence")))

    executed = entries.groupBy("ophe_id").agg(
        F.min_by(entry, "actual_sequence").alias("out"), latest(reached).alias("furthest"),
        latest(F.col("planned_sequence") == F.col("end_at")).alias("at_end"),
        latest(F.col("planned_sequence") == F.col("call_at")).alias("here"),
        F.size(F.collect_set(F.when(F.col("is_cancelled"), F.col("planned_sequence")))).alias("n_cancelled"))
    x = runs.join(executed, "ophe_id", "left").select(
        "*", F.col("origin.dsta_id").alias("relacja_od_id"), F.col("target.dsta_id").alias("relacja_do_id"),
        F.col("furthest.dsta_id").alias("ostatnia_stacja_id"))
    for id_col, name_col in (("relacja_od_id", "relacja_od"), ("relacja_do_id", "relacja_do"),
                             ("ostatnia_stacja_id", "ostatnia_stacja_nazwa")):
        x = _station_name(s, x, id_col, name_col)
    x = _carrier_and_category(s, x)
    ended, arrived = F.col("train_status") == "C", F.coalesce(F.col("at_end.reached"), F.lit(False))
    final = F.when(arrived, F.col("at_end")).when(ended, F.col("furthest"))
    at = F.col("call.order_number")
    due_start, due_end = (_instant("origin.departure_day", "origin.departure_time"),
                          _instant("target.arrival_day", "target.arrival_time"))

    def due(seconds: F.Column, name: str) -> F.Column:
        return _clock(F.timestamp_seconds(seconds), name)

    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "ophe_id", "schedule_id", "order_id",
        "train_order_id", "train_status", _flag(F.col("train_status") == "X", "czy_odwolany"),
        _flag(ended | arrived, "czy_dojechal"), _flag(ended & F.col("at_end").isNull(), "czy_koniec_poza_pomiarem"),
        F.coalesce("n_cancelled", F.lit(0)).cast("bigint").alias("liczba_stacji_odwolanych"),
        "przewoznik", "przewoznik_nazwa", "kategoria", "kategoria_nazwa", "nr_pociagu", "nazwa_pociagu",
        "relacja_od_id", "relacja_od", "relacja_do_id", "relacja_do",
        F.when(at == F.col("origin.order_number"), "START").when(at == F.col("target.order_number"), "KONIEC")
        .otherwise("PRZEJAZD").alias("rola_wroclawia"),
        due(due_start, "plan_odjazd_start"), _clock(F.col("out.actual_departure"), "rz_odjazd_start"),
        F.col("out.departure_delay_min").alias("opoznienie_start_min"),
        due(due_end, "plan_przyjazd_koniec"), _clock(final["actual_arrival"], "rz_przyjazd_koniec"),
        final["arrival_delay_min"].alias("opoznienie_koniec_min"),
        "ostatnia_stacja_id", "ostatnia_stacja_nazwa", _clock(F.col("furthest.actual_arrival"), "rz_przyjazd_ostatnia"),
        F.col("furthest.arrival_delay_min").alias("opoznienie_ostatnia_min"),
        due(_instant("call.arrival_day", "call.arrival_time"), "plan_wro_przyjazd"),
        due(_instant("call.departure_day", "call.departure_time"), "plan_wro_odjazd"),
        _clock(F.col("here.actual_arrival"), "rz_wro_przyjazd"), _clock(F.col("here.actual_departure"), "rz_wro_odjazd"),
        F.col("here.arrival_delay_min").alias("opoznienie_wro_przyjazd_min"),
        F.col("here.departure_delay_min").alias("opoznienie_wro_odjazd_min"),
        _flag(F.col("here.cancelled"), "czy_wro_odwolany"),
        F.round((due_end - due_start) / 60.0).cast("bigint").alias("plan_czas_przejazdu_min"))


def run_disruptions(s: Silver, as_of: dt.date, station_id) -> DataFrame:
    """H19 disruption sections of the completed runs (D-7..D-1 via the station).

    A run and an affected stop are each known by two ids, of the order and of the train; either one matches, so both
    sides are exploded to (kind, id) and joined once. Per run and disruption the section runs from the lowest to the
    highest affected sequence. Text: description by type code, by trimmed message, the message, the code; station
    placeholders are filled in. Same text on the same section = one row (newest header id).
    """
    lo, hi = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=1)
    by_id = F.inline(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("known_as"))
                               for c in ("order_id", "train_order_id"))))
    runs = _runs_calling(s, lo, hi, station_id).select("ophe_id", "operating_date", "schedule_id", by_id)
    stops = s.disruption_details.where(_days(lo, hi)).select(
        "operating_date", "schedule_id", "order_id", "train_order_id", "dihe_id", "sequence_number", "dsta_id")
    key = ["operating_date", "schedule_id", "kind", "known_as"]
    met = runs.join(stops.select("*", by_id), key).drop("kind", "known_as").distinct()
    place = F.struct("sequence_number", "dsta_id")
    x = met.groupBy("ophe_id", "dihe_id").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).cast("bigint").alias("liczba_przystankow"))
    x = x.select("ophe_id", "dihe_id", "liczba_przystankow", F.col("low.sequence_number").alias("dis_seq_od"),
                 F.col("low.dsta_id").alias("dsta_od"), F.col("high.sequence_number").alias("dis_seq_do"),
                 F.col("high.dsta_id").alias("dsta_do"))
    x = _station_name(s, _station_name(s, x, "dsta_od", "stacja_od"), "dsta_do", "stacja_do")
    heads = s.disruption_header.select(F.col("id").alias("dihe_id"), F.col("disruption_type_code").alias("code"), "message",
                                       F.trim("message").alias("said"))
    texts = s.def_disruption_cause.select("code", "description")
    x = (x.join(heads, "dihe_id").join(texts, "code", "left")
         .join(texts.select(F.col("code").alias("said"), F.col("description").alias("said_text")), "said", "left"))
    text = F.coalesce("description", "said_text", "message", "code")
    for mark, name in (("{stacja_poczatkowa}", "stacja_od"), ("{stacja_koncowa}", "stacja_do")):
        text = F.replace(text, F.lit(mark), F.coalesce(F.col(name), F.lit("")))
    cols = ["dsta_od", "stacja_od", "dsta_do", "stacja_do", "dis_seq_od", "dis_seq_do", "liczba_przystankow"]
    newest = x.withColumn("opis", text).groupBy("ophe_id", "dsta_od", "dsta_do", "opis").agg(
        F.max_by(F.struct("dihe_id", *cols[1::2], *cols[4::2]), "dihe_id").alias("r"))
    return newest.select("ophe_id", "r.dihe_id", "dsta_od", "r.stacja_od", "dsta_do", "r.stacja_do", "r.dis_seq_od",
                         "r.dis_seq_do", "r.liczba_przystankow", "opis")


def model_plan_stops(s: Silver, as_of: dt.date, months: int = 24) -> DataFrame:
    """H21 model plan per month, route and category, then its stops.

    Candidates: plans of runs in the month whose version of the train type
    has the category; the plan's ends are the route. The plan with the most
    stops with an arrival wins (ties: lowest schedule id, then order id),
    chosen by one grouped max over a struct (map-side partial aggregation,
    no month x route x category cross join).
    """
    m0 = as_of.year * 12 + as_of.month - 1 - (months - 1)
    first_month = dt.date(m0 // 12, m0 % 12 + 1, 1)
    nxt = (as_of.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    oh = s.operation_header.filter(F.col("operating_date").between(F.lit(first_month),
                                                                   F.lit(nxt - dt.timedelta(days=1)))).select(*HDR)
    sh = s.schedule_header.select(*HDR, "category_code", "carrier_code")
    tt = train_types(s).select("category_code", "carrier_code", "valid_from", "valid_to", "category_name")
    r = (oh.join(sh, HDR, "inner").join(tt, ["category_code", "carrier_code"], "inner")
         .filter(F.col("operating_date").between(F.col("valid_from"), F.col("valid_to")))
         .select((F.year("operating_date") * 100 + F.month("operating_date")).cast("bigint").alias("month"),
                 "schedule_id", "order_id", "category_name").distinct())
    sd = s.schedule_details
    plans = sd.groupBy("schedule_id", "order_id").agg(
        F.min(F.struct("order_number", "dsta_id")).alias("f"), F.max(F.struct("order_number", "dsta_id")).alias("l"),
        F.count_distinct(F.when(F.col("arrival_time").isNotNull(), F.col("order_number"))).alias("n_arr"))
    plans = plans.select("schedule_id", "order_id", F.col("f.dsta_id").alias("from_station_id"),
                         F.col("l.dsta_id").alias("to_station_id"), "n_arr")
    cand = r.join(plans, ["schedule_id", "order_id"], "inner")
    key = ["month", "from_station_id", "to_station_id", "category_name"]
    best = cand.groupBy(*key).agg(F.max(F.struct(
        "n_arr", (-F.col("schedule_id")).alias("ns"), (-F.col("order_id")).alias("no"))).alias("b"))
    best = best.select(*key, (-F.col("b.ns")).alias("schedule_id"), (-F.col("b.no")).alias("order_id"))
    stops = sd.join(best.select("schedule_id", "order_id").distinct(), ["schedule_id", "order_id"], "left_semi")
    pe = stops.groupBy("schedule_id", "order_id").agg(F.min("order_number").alias("_mn"),
                                                      F.max("order_number").alias("_mx"))
    st = s.def_station.select(F.col("id").alias("dsta_id"), F.col("name").alias("stacja_nazwa"))
    x = stops.join(pe, ["schedule_id", "order_id"]).join(st, "dsta_id", "inner")
    x = x.select("schedule_id", "order_id", F.col("order_number").alias("stacja_kolejnosc"),
                 F.col("dsta_id").alias("stacja_id"), "stacja_nazwa", "arrival_time",
                 F.when(F.col("order_number") == F.col("_mn"), 1).otherwise(0).alias("czy_start"),
                 F.when(F.col("order_number") == F.col("_mx"), 1).otherwise(0).alias("czy_koniec"))
    x = x.filter(F.col("arrival_time").isNotNull() | (F.col("czy_start") == 1))
    return best.join(x, ["schedule_id", "order_id"], "inner").select(
        *key, "stacja_kolejnosc", "stacja_id", "stacja_nazwa", "czy_start", "czy_koniec")


# Fixed value: a platform / track is kept only when it is digits plus an optional letter.
PLATFORM_RE = r"(?i)^\d+[a-z]?$"


def _plan_secs(sd: DataFrame) -> DataFrame:
    return sd.select("*", _clock_day_minutes("arrival_time", "arrival_day").alias("arr_sec"),
                     _clock_day_minutes("departure_time", "departure_day").alias("dep_sec"),
                     F.col("departure_category").alias("_dep_cat"), F.col("arrival_category").alias("_arr_cat"),
                     F.col("departure_train_no").alias("_dep_no"), F.col("arrival_train_no").alias("_arr_no"))


def _departing_calls(s: Silver, today: dt.date, station_id) -> tuple[DataFrame, DataFrame]:
    kurs = s.schedule_header.filter((F.col("is_active") == 1)
                                    & (F.col("operating_date") >= F.lit(today - dt.timedelta(days=1))))
    sdx = _plan_secs(s.schedule_details)
    wro = sdx.filter((F.col("dsta_id") == station_id) & F.col("dep_sec").isNotNull()
                     & (F.coalesce(F.col("dstty_id"), F.lit(0)) != 2)).select(
        "schedule_id", "order_id", F.col("order_number").alias("wro_order"), F.col("dep_sec").alias("wro_dep_sec"),
        F.col("departure_platform").alias("wro_peron_raw"), F.col("departure_track").alias("wro_tor_raw"),
        F.col("_dep_cat").alias("wro_kategoria"), F.col("_dep_no").alias("wro_nr_pociagu"))
    return kurs.join(wro, ["schedule_id", "order_id"], "inner"), sdx


def _keep_platform(c: F.Column) -> F.Column:
    return F.when(c.rlike(PLATFORM_RE), c)


def timetable_from_station(s: Silver, today: dt.date, station_id) -> DataFrame:
    """H16 each later stop of active runs departing from the station today or later.

    The station row must have a departure and not be an alighting-only stop;
    target rows have a higher order number and an arrival (equi join on the
    plan key + an inequality residual, bounded by the stops of one plan).
    """
    kw, sdx = _departing_calls(s, today, station_id)
    kw = kw.filter(F.col("operating_date").cast("timestamp") + F.make_dt_interval(secs=F.col("wro_dep_sec"))
                   >= F.lit(today).cast("timestamp"))
    tgt = sdx.filter(F.col("arr_sec").isNotNull()).select(
        "schedule_id", "order_id", F.col("order_number").alias("stacja_kolejnosc"), F.col("dsta_id").alias("stacja_id"),
        "arr_sec", "dep_sec", "arrival_platform", "departure_platform", "arrival_track", "departure_track", "dstty_id")
    x = kw.alias("k").join(tgt.alias("t"), (F.col("k.schedule_id") == F.col("t.schedule_id"))
                           & (F.col("k.order_id") == F.col("t.order_id"))
                           & (F.col("t.stacja_kolejnosc") > F.col("k.wro_order")), "inner")
    x = x.select("k.*", "t.stacja_kolejnosc", "t.stacja_id", "t.arr_sec", "t.dep_sec", "t.arrival_platform",
                 "t.departure_platform", "t.arrival_track", "t.departure_track", "t.dstty_id")
    st = s.def_station.select("id", "name")
    ends = plan_ends(s.schedule_details.join(kw.select("schedule_id", "order_id").distinct(),
                                             ["schedule_id", "order_id"], "left_semi"))
    x = (x.join(st.select(F.col("id").alias("stacja_id"), F.col("name").alias("stacja_nazwa")), "stacja_id", "inner")
         .join(ends.select("schedule_id", "order_id", "from_station_id", "to_station_id"),
               ["schedule_id", "order_id"], "inner")
         .join(st.select(F.col("id").alias("from_station_id"), F.col("name").alias("relacja_od")), "from_station_id",
               "left")
         .join(st.select(F.col("id").alias("to_station_id"), F.col("name").alias("relacja_do")), "to_station_id",
               "left"))
    stt = s.def_stop_type.select(F.col("id").alias("dstty_id"),
                                                   F.col("description").alias("stacja_typ_postoju_opis"))
    x = x.join(stt, "dstty_id", "left").withColumn("kategoria", F.coalesce("wro_kategoria", "category_code"))
    cat = s.def_commercial_category.select(
        F.col("code").alias("kategoria"), F.col("carrier_code").alias("carrier_code"),
        F.col("name").alias("kategoria_nazwa"))
    car = s.def_carrier.select(F.col("code").alias("carrier_code"), "name", "valid_from", "valid_to")
    cn = (x.select("operating_date", "carrier_code").distinct().join(car, "carrier_code")
          .filter(F.col("operating_date").between(F.col("valid_from"), F.col("valid_to")))
          .groupBy("operating_date", "carrier_code")
          .agg(keep_last_max([F.col("valid_from")], "name").alias("przewoznik_nazwa")))
    x = x.join(cat, ["kategoria", "carrier_code"], "left").join(cn, ["operating_date", "carrier_code"], "left")
    base = date_epoch_seconds(F.col("operating_date"))
    mins = F.round((F.col("arr_sec") - F.col("wro_dep_sec")) / 60.0).cast("bigint")
    plat = F.coalesce("arrival_platform", "departure_platform")
    track = F.coalesce("arrival_track", "departure_track")
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id", "order_id",
        "train_order_id", F.col("carrier_code").alias("przewoznik"), "przewoznik_nazwa", "kategoria",
        "kategoria_nazwa", F.coalesce("wro_nr_pociagu", "national_number").alias("nr_pociagu"),
        F.col("name").alias("nazwa_pociagu"), "relacja_od", "relacja_do",
        F.date_format(F.timestamp_seconds(base + F.col("wro_dep_sec")), "yyyy-MM-dd").alias("dzien_odjazdu"),
        F.date_format(F.timestamp_seconds(base + F.col("wro_dep_sec")), TS).alias("wro_odjazd"),
        _keep_platform(F.col("wro_peron_raw")).alias("wro_peron"), _keep_platform(F.col("wro_tor_raw")).alias("wro_tor"),
        "stacja_kolejnosc", "stacja_id", "stacja_nazwa",
        F.date_format(F.timestamp_seconds(base + F.col("arr_sec")), TS).alias("stacja_przyjazd"),
        F.date_format(F.timestamp_seconds(base + F.col("dep_sec")), TS).alias("stacja_odjazd"),
        _keep_platform(plat).alias("stacja_peron"), _keep_platform(track).alias("stacja_tor"),
        F.col("dstty_id").alias("stacja_typ_postoju_id"), "stacja_typ_postoju_opis",
        F.when(F.col("dep_sec").isNull(), 1).otherwise(0).alias("czy_stacja_koncowa"),
        mins.alias("czas_przejazdu_min"),
        F.concat((mins / 60).cast("bigint").cast("string"), F.lit("h:"),
                 F.lpad((mins % 60).cast("string"), 2, "0"), F.lit("min")).alias("czas_przejazdu"),
    )


def route_from_station(s: Silver, today: dt.date, station_id) -> DataFrame:
    """H17 stops of active runs from the station (inclusive) to the end."""
    kw, sdx = _departing_calls(s, today, station_id)
    tgt = sdx.select("schedule_id", "order_id", F.col("order_number").alias("stacja_kolejnosc"),
                     F.col("dsta_id").alias("stacja_id"), "arr_sec", "dep_sec", "arrival_platform",
                     "departure_platform", "arrival_track", "departure_track", "dstty_id", "_dep_cat", "_arr_cat",
                     "_dep_no", "_arr_no")
    x = kw.alias("k").join(tgt.alias("t"), (F.col("k.schedule_id") == F.col("t.schedule_id"))
                           & (F.col("k.order_id") == F.col("t.order_id"))
                           & (F.col("t.stacja_kolejnosc") >= F.col("k.wro_order"))
                           & (F.col("t.arr_sec").isNotNull() | (F.col("t.stacja_kolejnosc") == F.col("k.wro_order"))),
                           "inner")
    x = x.select(
        F.col("k.operating_date").alias("operating_date"), F.col("k.schedule_id").alias("schedule_id"),
        F.col("k.order_id").alias("order_id"), F.col("k.train_order_id").alias("train_order_id"),
        F.col("k.carrier_code").alias("carrier_code"), F.col("k.name").alias("nazwa_pociagu"),
        F.col("k.wro_order").alias("wro_order"), *[F.col(f"t.{c}").alias(c) for c in tgt.columns
                                                   if c not in ("schedule_id", "order_id")])
    st = s.def_station.select(F.col("id").alias("stacja_id"), F.col("name").alias("stacja_nazwa"))
    stt = s.def_stop_type.select(F.col("id").alias("dstty_id"),
                                                   F.col("description").alias("typ_postoju_opis"))
    x = x.join(st, "stacja_id", "inner").join(stt, "dstty_id", "left").withColumn(
        "kategoria", F.coalesce("_dep_cat", "_arr_cat"))
    cat = s.def_commercial_category.select(
        F.col("code").alias("kategoria"), "carrier_code", F.col("name").alias("kategoria_nazwa"))
    x = x.join(cat, ["kategoria", "carrier_code"], "left")
    base = date_epoch_seconds(F.col("operating_date"))
    plat = F.coalesce("arrival_platform", "departure_platform")
    track = F.coalesce("arrival_track", "departure_track")
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id", "order_id",
        "train_order_id", F.col("carrier_code").alias("przewoznik"), "nazwa_pociagu", "stacja_kolejnosc",
        "stacja_id", "stacja_nazwa",
        F.when(F.col("stacja_kolejnosc") == F.col("wro_order"), 1).otherwise(0).alias("czy_wroclaw"),
        F.when(F.col("dep_sec").isNull(), 1).otherwise(0).alias("czy_stacja_koncowa"),
        F.date_format(F.timestamp_seconds(base + F.col("arr_sec")), TS).alias("przyjazd"),
        F.date_format(F.timestamp_seconds(base + F.col("dep_sec")), TS).alias("odjazd"),
        _keep_platform(plat).alias("peron"), _keep_platform(track).alias("tor"), "kategoria", "kategoria_nazwa",
        F.coalesce("_dep_no", "_arr_no").alias("nr_pociagu"), F.col("dstty_id").alias("typ_postoju_id"),
        "typ_postoju_opis")


def run_stops(s: Silver, as_of: dt.date, station_id) -> DataFrame:
    """H20 completed run x plan stop with plan, execution and disrupted-section flags.

    Executed: the latest entry of the planned position. A section (H19) begins at the first plan position of one of
    its stations and ends at the last position of the other, two equi joins with the positions of each station in
    the plan; it is then spread over its positions (``sequence``, bounded by one plan) and one grouping makes flags
    and the ordered text of the sections that begin at a stop.
    """
    lo, hi = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=1)
    runs = _labelled(s, _runs_calling(s, lo, hi, station_id), lo, hi).drop("kategoria", "nr_pociagu")
    stops = _stops_of(s, runs)
    places = stops.groupBy(*PLAN, "dsta_id").agg(F.min("order_number").alias("first_at"), F.max("order_number").alias("last_at"))
    extent = places.groupBy(*PLAN).agg(F.min("first_at").alias("min_on"), F.max("last_at").alias("max_on"))
    begin = places.select(*PLAN, F.col("dsta_id").alias("dsta_od"), "first_at")
    finish = places.select(*PLAN, F.col("dsta_id").alias("dsta_do"), "last_at")
    sections = (run_disruptions(s, as_of, station_id).join(runs.select("ophe_id", *PLAN), "ophe_id")
                .join(begin, [*PLAN, "dsta_od"]).join(finish, [*PLAN, "dsta_do"])
                .select("ophe_id", "opis", F.least("first_at", "last_at").alias("low"), F.greatest("first_at", "last_at").alias("high"),
                        F.concat_ws("", "opis", F.lit(" ["), "stacja_od", F.lit(" → "), "stacja_do", F.lit("]")).alias("line")))
    begins = F.col("order_number") == F.col("low")
    lines = F.array_sort(F.collect_list(F.when(begins, F.struct("high", "opis", "line"))))
    marks = (sections.withColumn("order_number", F.explode(F.sequence("low", "high"))).groupBy("ophe_id", "order_number")
             .agg(F.max((F.col("order_number") < F.col("high")).cast("int")).alias("odcinek"), lines.alias("lines")))
    entry = F.struct("actual_arrival", "actual_departure", "arrival_delay_min", "departure_delay_min", "is_confirmed",
                     "is_cancelled")
    executed = (s.operation_details.where(_days(lo, hi)).join(runs.select("ophe_id"), "ophe_id", "left_semi")
                .groupBy("ophe_id", F.col("planned_sequence").alias("order_number"))
                .agg(F.max_by(entry, "actual_sequence").alias("e")))
    x = (runs.join(stops, PLAN).join(extent, PLAN)
         .where(F.col("arrival_time").isNotNull() | (F.col("order_number") == F.col("min_on")))
         .join(executed, ["ophe_id", "order_number"], "left").join(marks, ["ophe_id", "order_number"], "left")
         .withColumn("kategoria", F.coalesce("departure_category", "arrival_category"))
         .join(s.def_stop_type.select(F.col("id").alias("dstty_id"), F.col("description").alias("typ_postoju_opis")),
               "dstty_id", "left"))
    x = _category(s, _station_name(s, x, "dsta_id", "stacja_nazwa"))
    role = _role("order_number", "min_on", "max_on")
    n = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "ophe_id", "schedule_id", "order_id",
        "train_order_id", "train_status", "przewoznik", "nazwa_pociagu",
        F.col("order_number").alias("stacja_kolejnosc"), F.col("dsta_id").alias("stacja_id"), "stacja_nazwa",
        _flag(F.col("dsta_id") == station_id, "czy_wroclaw"), _flag(role["czy_start"], "czy_start"),
        _flag(role["czy_koniec"], "czy_koniec"),
        _clock(F.timestamp_seconds(_instant("arrival_day", "arrival_time")), "plan_przyjazd"),
        _clock(F.timestamp_seconds(_instant("departure_day", "departure_time")), "plan_odjazd"),
        _clock(F.col("e.actual_arrival"), "rz_przyjazd"), _clock(F.col("e.actual_departure"), "rz_odjazd"),
        F.col("e.arrival_delay_min").alias("opoznienie_przyjazd_min"),
        F.col("e.departure_delay_min").alias("opoznienie_odjazd_min"),
        _flag(F.col("e.is_confirmed"), "czy_potwierdzony"), _flag(F.col("e.is_cancelled"), "czy_odwolany"),
        _flag(F.col("e").isNull(), "czy_brak_pomiaru"),
        _keep_platform(F.coalesce("arrival_platform", "departure_platform")).alias("peron"),
        _keep_platform(F.coalesce("arrival_track", "departure_track")).alias("tor"), "kategoria", "kategoria_nazwa",
        F.coalesce("departure_train_no", "arrival_train_no").alias("nr_pociagu"),
        F.col("dstty_id").alias("typ_postoju_id"), "typ_postoju_opis",
        _flag(F.col("lines").isNotNull(), "czy_stacja_utrudniona"),
        F.coalesce("odcinek", F.lit(0)).alias("czy_odcinek_utrudniony"), n.cast("bigint").alias("liczba_utrudnien_start"),
        F.when(n > 0, F.array_join(F.transform("lines", lambda e: e["line"]), "\n")).alias("utrudnienia_start_txt"))
