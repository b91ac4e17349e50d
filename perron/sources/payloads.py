"""Feed documents built from the fixture tables (the bronze layer of a run).

Each feed becomes a landing DataFrame ``(object_name, payload)`` with one
JSON document per page, exactly as the API files land in the bucket
(``daily/<category>/<feed>/date=YYYYMMDD/<file>``). Pages are bounded
(``page_size`` runs / entries per document), so no document -- and no
``collect_list`` group that builds it -- grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.sources.fixtures import Fixture, executed_stop, plan_stop

PAGE_SIZE = 200
TS_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _iso(ts: Column) -> Column:
    return F.date_format(ts, TS_FMT)


def _run_ts(d: Column, hhmmss: str = "060000") -> Column:
    """Run timestamp (14 digits) of the daily fetch: the morning after the business date."""
    return F.concat(F.date_format(F.date_add(d, 1), "yyyyMMdd"), F.lit(hhmmss))


def _object_name(category: str, feed: str, biz: Column, run_ts: Column, page: Column | None) -> Column:
    part = F.substring(run_ts, 1, 8)
    fname = F.concat(F.lit(f"{feed}_"), biz, F.lit("_"), run_ts,
                     F.concat(F.lit("_p"), F.format_string("%03d", page)) if page is not None else F.lit(""),
                     F.lit(".json"))
    return F.concat(F.lit(f"daily/{category}/{feed}/date="), part, F.lit("/"), fname)


def _runs_with_lines(fx: Fixture, run: Column, lines: list[str]) -> DataFrame:
    """(page_key, order_id, lines, run): each run with its line items in their order, from one shuffle, by page of run ids.

    Runs and line items are dealt out together, so what is grouped by run, and then by page, is not shuffled again.
    """
    page = (F.col("order_id") / PAGE_SIZE).cast("bigint").alias("page_key")
    runs = fx.runs().select(page, "order_id", run.alias("run"))
    items = fx.table("lineitem").where(F.col("l_orderkey").isNotNull()).select(F.col("l_orderkey").alias("order_id"), F.struct(*lines).alias("line"))
    both = runs.unionByName(items.select(page, "order_id", "line"), allowMissingColumns=True).repartition("page_key")
    groups = both.groupBy("page_key", "order_id").agg(F.sort_array(F.collect_list("line")).alias("lines"), F.collect_list("run").alias("runs"))
    return groups.select("page_key", "order_id", "lines", F.explode("runs").alias("run"))


def _operations_docs(fx: Fixture) -> DataFrame:
    """Executed runs: (operating_date, page_key, trains), a row per business date and page of run ids."""
    run = F.struct("schedule_id", "train_order_id", "operating_date", "train_status")
    # the order of the columns is that of the stops of a run
    runs = _runs_with_lines(fx, run, ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus"])

    def station(line: Column, i: Column) -> Column:
        s = executed_stop(lambda n: line[n], F.col("order_id"), i + 1)
        return F.struct(
            s["actual_sequence"].alias("actualSequenceNumber"), s["dsta_id"].alias("stationId"), s["planned_sequence"].alias("plannedSequenceNumber"),
            _iso(s["actual_arrival"]).alias("actualArrival"), _iso(s["actual_departure"]).alias("actualDeparture"),
            s["arrival_delay_min"].alias("arrivalDelayMinutes"), s["departure_delay_min"].alias("departureDelayMinutes"),
            s["is_confirmed"].alias("isConfirmed"), s["is_cancelled"].alias("isCancelled"))

    trains = runs.select("page_key", F.col("run.operating_date").alias("operating_date"), F.struct(
        F.col("run.schedule_id").alias("scheduleId"), F.col("order_id").alias("orderId"), F.col("run.train_order_id").alias("trainOrderId"),
        F.date_format("run.operating_date", "yyyy-MM-dd").alias("operatingDate"), F.col("run.train_status").alias("trainStatus"),
        F.transform("lines", station).alias("stations")).alias("train"))
    return trains.groupBy("operating_date", "page_key").agg(F.collect_list("train").alias("trains"))


def operations_landing(fx: Fixture, *hhmmss: str) -> DataFrame:
    """One document per (business date, page of run ids) and time of the fetch (06:00 if none is given)."""
    docs, hhmmss = _operations_docs(fx), hhmmss or ("060000",)
    at = F.lit(hhmmss[0])
    if len(hhmmss) > 1:  # the pages are made once for all fetches
        docs, at = docs.withColumn("at", F.explode(F.array(*map(F.lit, hhmmss)))), F.col("at")
    biz = F.date_format("operating_date", "yyyyMMdd")
    run_ts = F.concat(_run_ts(F.col("operating_date"), ""), at)
    page = F.col("page_key") + 1
    payload = F.to_json(F.struct(
        F.concat(F.date_format(F.date_add("operating_date", 1), "yyyy-MM-dd"),
                 F.lit("T"), F.substring(at, 1, 2), F.lit(":"), F.substring(at, 3, 2), F.lit(":"), F.substring(at, 5, 2), F.lit("Z")).alias("generatedAt"),
        F.struct(page.cast("int").alias("page"), F.lit(PAGE_SIZE).alias("pageSize"),
                 F.lit(None).cast("bigint").alias("totalCount"), F.lit(None).cast("int").alias("totalPages"),
                 F.lit(None).cast("boolean").alias("hasNextPage")).alias("pagination"),
        F.col("trains")))
    return docs.select(_object_name("data", "operations", biz, run_ts, page).alias("object_name"),
                       payload.alias("payload"))


def schedules_landing(fx: Fixture) -> DataFrame:
    """Timetable routes with their stops and running dates, paged by route id."""
    run = F.struct("schedule_id", "train_order_id", "operating_date", "carrier_code", "category_code")
    # of lines with one number, the first in the order of the columns is the plan's
    x = _runs_with_lines(fx, run, ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    numbers = F.transform("lines", lambda line: line["l_linenumber"])
    x = x.where(F.size("lines") > 0).select("page_key", "order_id", "run", F.array_min(numbers).alias("lo"), F.array_max(numbers).alias("hi"), F.filter(
        "lines", lambda line, i: (i == 0) | ~line["l_linenumber"].eqNullSafe(F.get(F.col("lines"), i - 1)["l_linenumber"])).alias("lines"))

    def station(line: Column) -> Column:
        s = plan_stop(lambda n: line[n], F.col("order_id"), line["l_linenumber"] == F.col("lo"), line["l_linenumber"] == F.col("hi"))
        return F.struct(
            s["order_number"].alias("orderNumber"), s["dsta_id"].alias("stationId"),
            s["arrival_time"].alias("arrivalTime"), s["arrival_day"].alias("arrivalDay"),
            s["arrival_platform"].alias("arrivalPlatform"), s["arrival_track"].alias("arrivalTrack"),
            s["arrival_category"].alias("arrivalCommercialCategory"), s["arrival_train_no"].alias("arrivalTrainNumber"),
            s["departure_time"].alias("departureTime"), s["departure_day"].alias("departureDay"),
            s["departure_platform"].alias("departurePlatform"), s["departure_track"].alias("departureTrack"),
            s["departure_category"].alias("departureCommercialCategory"), s["departure_train_no"].alias("departureTrainNumber"),
            s["dstty_id"].alias("stopTypeId"))

    number = F.col("order_id").cast("string")
    routes = x.select("page_key", F.struct(
        F.col("run.schedule_id").alias("scheduleId"), F.col("order_id").alias("orderId"), F.col("run.train_order_id").alias("trainOrderId"),
        F.concat(F.lit("Pociag "), number).alias("name"), F.col("run.carrier_code").alias("carrierCode"), number.alias("nationalNumber"),
        F.col("run.category_code").alias("commercialCategorySymbol"), F.array(F.date_format("run.operating_date", "yyyy-MM-dd")).alias("operatingDates"),
        F.transform("lines", station).alias("stations")).alias("route"))
    docs = routes.groupBy("page_key").agg(F.collect_list("route").alias("routes"))
    run_ts = F.lit("20010722060000")
    page = F.col("page_key") + 1
    payload = F.to_json(F.struct(F.lit("2001-07-22T06:00:00Z").alias("generatedAt"), "routes"))
    return docs.select(_object_name("data", "schedules", F.lit("20010722"), run_ts, page).alias("object_name"),
                       payload.alias("payload"))


def disruptions_landing(fx: Fixture) -> DataFrame:
    """Disruptions with affected stops, one document per (business date, page)."""
    d = fx._disruption_rows()
    dis = d.select(
        "operating_date", (F.col("disruption_id") / (PAGE_SIZE * 100)).cast("bigint").alias("page_key"),
        F.struct(F.col("disruption_id").alias("disruptionId"), F.col("disruption_type_code").alias("disruptionTypeCode"),
                 "message",
                 F.array(F.struct(F.lit(2001).cast("bigint").alias("scheduleId"), F.col("l_orderkey").alias("orderId"),
                                  F.col("l_orderkey").alias("trainOrderId"),
                                  F.date_format("operating_date", "yyyy-MM-dd").alias("operatingDate"),
                                  (F.col("l_suppkey") % 10).alias("stationId"),
                                  F.col("l_linenumber").alias("sequenceNumber"))).alias("affectedRoutes"))
        .alias("d"))
    docs = dis.groupBy("operating_date", "page_key").agg(F.collect_list("d").alias("disruptions"))
    biz = F.date_format("operating_date", "yyyyMMdd")
    run_ts = _run_ts(F.col("operating_date"))
    page = F.col("page_key") + 1
    payload = F.to_json(F.struct(F.concat(F.date_format(F.date_add("operating_date", 1), "yyyy-MM-dd"),
                                          F.lit("T06:00:00Z")).alias("generatedAt"), "disruptions"))
    return docs.select(_object_name("data", "disruptions", biz, run_ts, page).alias("object_name"),
                       payload.alias("payload"))


def _dict_doc(entries: DataFrame, name: str, field: str, key: Column, extra: dict | None = None) -> DataFrame:
    """Dictionary documents paged by entry key (each page bounded by PAGE_SIZE)."""
    x = entries.select((key / PAGE_SIZE).cast("bigint").alias("page_key"), F.col("e"))
    docs = x.groupBy("page_key").agg(F.collect_list("e").alias(field))
    cols = [F.lit("2001-07-22T06:00:00Z").alias("generatedAt"), F.col(field)]
    fname = F.concat(F.lit(f"daily/dict/{name}/date=20010722/dict_{name}_20010722060000_p"),
                     F.format_string("%03d", F.col("page_key") + 1), F.lit(".json"))
    return docs.select(fname.alias("object_name"), F.to_json(F.struct(*cols)).alias("payload"))


def stations_landing(fx: Fixture) -> DataFrame:
    s = fx.def_station()
    return _dict_doc(s.select("id", F.struct("id", "name").alias("e")), "stations", "stations", F.col("id"))


def cities_landing(fx: Fixture) -> DataFrame:
    """Cities with the station ids they group (a nation with its suppliers)."""
    st = fx.def_station()
    c = fx.def_city()
    members = st.groupBy("dcit_id").agg(F.sort_array(F.collect_list("id")).alias("stationIds"))
    e = c.join(members, c.id == members.dcit_id, "inner").select(
        "id", F.struct("name", F.size("stationIds").alias("stationCount"), "stationIds").alias("e"))
    return _dict_doc(e, "cities", "cities", F.col("id"))


def carriers_landing(fx: Fixture) -> DataFrame:
    c = fx.def_carrier()
    e = c.select(F.lit(0).alias("k"), F.struct("code", "name", F.col("valid_from").cast("string").alias("validFrom"),
                                               F.col("valid_to").cast("string").alias("validTo")).alias("e"))
    return _dict_doc(e, "carriers", "carriers", F.col("k"))


def categories_landing(fx: Fixture) -> DataFrame:
    c = fx.def_commercial_category()
    e = c.select(F.lit(0).alias("k"), F.struct("code", "name", F.col("carrier_code").alias("carrierCode"),
                                               F.col("speed_category_code").alias("speedCategoryCode")).alias("e"))
    return _dict_doc(e, "commercial_categories", "commercialCategories", F.col("k"))


def stop_types_landing(fx: Fixture) -> DataFrame:
    e = fx.def_stop_type().select(F.lit(0).alias("k"), F.struct("id", "description").alias("e"))
    return _dict_doc(e, "stop_types", "stopTypes", F.col("k"))


def _map_doc(kv: DataFrame, name: str, field: str) -> DataFrame:
    docs = kv.groupBy(F.lit(0).alias("page_key")).agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))
                                                      .alias(field))
    fname = F.lit(f"daily/dict/{name}/date=20010722/dict_{name}_20010722060000.json")
    return docs.select(fname.alias("object_name"), F.to_json(F.struct(
        F.lit("2001-07-22T06:00:00Z").alias("generatedAt"), F.col(field))).alias("payload"))


def train_statuses_landing(fx: Fixture) -> DataFrame:
    return _map_doc(fx.def_train_status().select(F.col("code").alias("k"), F.col("name").alias("v")),
                    "train_statuses", "trainStatuses")


def disruption_types_landing(fx: Fixture) -> DataFrame:
    return _map_doc(fx.def_disruption_cause().select(F.col("code").alias("k"), F.col("description").alias("v")),
                    "disruption_types", "disruptionTypes")


def live_pages(fx: Fixture) -> DataFrame:
    """Pages of live fetches at 05:00 and 06:00 of the day after each business date, with the micro-batch that brings them.

    (object_name, payload, batch). Two dates make a batch; of the second, pages with odd numbers come a batch later. By
    the day number modulo 5: 0 = the 05:00 fetch's last page is cut off, 1 = it is missing, 2 = the 06:00 fetch still
    bears the stamp of 04:00; else both fetches are sound and alike.
    """
    pages = operations_landing(fx, "050000", "060000")
    biz = F.to_date(F.regexp_extract("object_name", r"operations_(\d{8})_", 1), "yyyyMMdd")
    x = pages.select("object_name", "payload", F.unix_date(biz).alias("day"), F.regexp_extract("object_name", r"_p(\d+)\.json$", 1).cast("int").alias("page"),
                     F.col("object_name").contains("050000").alias("early"))
    last = x.groupBy("day").agg(F.max("page").alias("last"))
    first = x.select(F.min("day")).scalar()
    # a row a day; the pages would all be dealt out by day else, to as few tasks as there are days
    x = x.join(F.broadcast(last), "day").withColumn("at_end", F.col("page") == F.col("last"))
    k = F.col("day") % 5
    text = F.replace("payload", F.lit('"pagination":{'), F.concat(F.lit('"pagination":{"hasNextPage":'), (~F.col("at_end")).cast("string"), F.lit(",")))
    text = F.when((k == 0) & F.col("early") & F.col("at_end"), F.substring(text, 1, 100)).when((k == 2) & ~F.col("early"), F.replace(text, F.lit("T06:00:00Z\",\"pagination"), F.lit("T04:00:00Z\",\"pagination"))).otherwise(text)
    x = x.where(~((k == 1) & F.col("early") & F.col("at_end")))
    nth = F.col("day") - first
    return x.select("object_name", text.alias("payload"), (F.floor(nth / 2) + F.when((nth % 2 == 1) & (F.col("page") % 2 == 1), 1).otherwise(0)).cast("int").alias("batch"))
