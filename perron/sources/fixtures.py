"""Adapters: the driver's TPC-H-style tables -> railway silver shapes.

The engine's jobs take silver-shaped DataFrames. These adapters derive them
from the driver tables so that every query's work grows with the input
(one run per order, one stop per line item, one snapshot per event day).
The same definitions are written in portable SQL in ``oracle/fixtures_sql.py``
for the DuckDB oracle; both must stay in step.

Mapping (all rows used, nothing sampled):
  run         <- orders (+ customer for the carrier)
  stop        <- lineitem (duplicated (order, line) pairs kept, ordered by a
                 total order so the actual sequence is deterministic)
  plan stop   <- first stop row per (order, line number)
  disruption  <- stop rows with return flag 'R', cause = part type
  station     <- supplier, city <- nation
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the adapter (both sides of the oracle use them).
BASE_DATE = "2001-07-23"          # runs fold into 2001-07-23 .. 2001-08-01
AS_OF = dt.date(2001, 8, 2)       # D-1 = 2001-08-01
LIVE_AS_OF = "2001-07-27 12:00:00"
SCHEDULE_ID = 2001
STATION_ID = 3                    # the station parameter of the station reports
N_STATIONS = 10
DISRUPTION_ID_FACTOR = 10 ** 10   # header id = date key * factor + disruption id
OPEN_END = "2999-12-31"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pct(c: Column) -> Column:
    return F.round(c * 100).cast("int")


def _tax_pct(c: str = "l_tax") -> Column:
    return _pct(F.col(c))


def _run_date(key: Column) -> Column:
    return F.date_add(F.lit(BASE_DATE).cast("date"), (key % 10).cast("int"))


def _clock(partkey: Column, qty: Column) -> Column:
    return F.concat(F.lpad((partkey % 24).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(qty.cast("int").cast("string"), 2, "0"), F.lit(":00"))


def plan_stop(c: Callable[[str], Column], order_id: Column, is_first: Column, is_last: Column) -> dict[str, Column]:
    """A plan stop's columns by name; ``c`` gives the line's column of a name, the ends say whether it is its run's first or last."""
    clock = _clock(c("l_partkey"), c("l_quantity"))
    day = F.call_function("div", c("l_linenumber"), F.lit(4)).cast("int")
    platform = F.when(_pct(c("l_tax")) == 6, F.lit("IV")).otherwise(
        F.concat((c("l_suppkey") % 8 + 1).cast("string"),
                 F.when(c("l_partkey") % 5 == 0, F.lit("a")).otherwise(F.lit(""))))
    track = (c("l_partkey") % 12 + 1).cast("string")
    # category and number of the train at the stop; some stops have none
    kind = c("l_partkey") % 4
    category = F.when(kind == 0, "A").when(kind == 1, "B").when(kind == 2, "C")
    number = F.when(c("l_suppkey") % 3 != 0,
                    F.concat(order_id.cast("string"), F.lit("/"), (c("l_suppkey") % 5).cast("string")))
    parts = {"time": clock, "day": day, "platform": platform, "track": track, "category": category, "train_no": number}
    return {"order_number": c("l_linenumber"), "dsta_id": c("l_suppkey") % N_STATIONS,
            **{f"arrival_{n}": F.when(~is_first, x) for n, x in parts.items()},
            **{f"departure_{n}": F.when(~is_last, x) for n, x in parts.items()},
            "dstty_id": F.when(_pct(c("l_discount")) == 0, 2).otherwise(1)}


def executed_stop(c: Callable[[str], Column], order_id: Column, seq: Column) -> dict[str, Column]:
    """An executed stop's columns by name; ``c`` gives the line's column of a name, ``seq`` is its place in the run."""
    delay = F.when(_pct(c("l_tax")) == 1, F.lit(None).cast("int")).otherwise(c("l_quantity").cast("int") - 20)
    base_sec = (F.unix_date(_run_date(order_id)).cast("bigint") * 86400
                + F.call_function("div", c("l_linenumber"), F.lit(4)) * 86400
                + (c("l_partkey") % 24) * 3600
                + c("l_quantity").cast("int") * 60)
    actual = F.timestamp_seconds(base_sec + F.coalesce(delay, F.lit(0)) * 60)
    return {"actual_sequence": seq.cast("int"), "planned_sequence": c("l_linenumber"), "dsta_id": c("l_suppkey") % N_STATIONS,
            "actual_arrival": F.when(_pct(c("l_tax")) != 0, actual), "actual_departure": F.when(_pct(c("l_tax")) != 5, actual),
            "is_confirmed": c("l_linestatus") == "F", "is_cancelled": c("l_returnflag") == "R",
            "arrival_delay_min": delay, "departure_delay_min": delay}


class Fixture:
    """Lazily built silver tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}

    def _once(self, key: str, build) -> DataFrame:
        # One DataFrame per shape: repeated use shares one analysed plan, and
        # Catalyst can reuse the exchange when a shape feeds several branches.
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    # ---- raw ------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return self._once("t:" + name, lambda: _read(self.spark, self.sf_dir, name))

    # ---- runs -----------------------------------------------------------
    def runs(self) -> DataFrame:
        """One row per run: header attributes of timetable and execution."""
        return self._once("runs", self._runs)

    def _runs(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        prio = F.substring("o_orderpriority", 1, 1)
        return (o.join(c, o.o_custkey == c.c_custkey, "inner")
                .select(
                    F.col("o_orderkey").alias("ophe_id"),
                    _run_date(F.col("o_orderkey")).alias("operating_date"),
                    F.lit(SCHEDULE_ID).cast("bigint").alias("schedule_id"),
                    F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderkey").alias("train_order_id"),
                    F.when(F.col("o_orderstatus") == "F", "C")
                     .when(F.col("o_orderstatus") == "O", "X")
                     .when(F.col("o_orderstatus") == "P", "Q").alias("train_status"),
                    F.when(F.col("o_orderkey") % 11 == 0, "A/B")
                     .when(prio == "1", "A")
                     .when(prio.isin("2", "3"), "B")
                     .otherwise("C").alias("category_code"),
                    F.when(F.col("c_mktsegment") == "BUILDING", "K1").otherwise("K2").alias("carrier_code"),
                ))

    def schedule_header(self) -> DataFrame:
        r = self.runs()
        return r.select(
            "operating_date", "schedule_id", "order_id", "train_order_id",
            F.concat(F.lit("Pociag "), F.col("order_id").cast("string")).alias("name"),
            "carrier_code", "category_code",
            F.col("order_id").cast("string").alias("national_number"),
            F.lit(1).alias("is_active"),
        )

    def operation_header(self) -> DataFrame:
        r = self.runs()
        return r.select(F.col("ophe_id").alias("id"), "operating_date", "schedule_id", "order_id",
                        "train_order_id", "train_status",
                        F.to_timestamp(F.concat(F.col("operating_date").cast("string"), F.lit(" 23:00:00")))
                        .alias("snapshot_ts"))

    # ---- stops ----------------------------------------------------------
    def stop_raw(self) -> DataFrame:
        """Every line item as a stop row, actual sequence by a total order."""
        return self._once("stop_raw", self._stop_raw)

    def _stop_raw(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        return li.withColumn("actual_sequence", F.row_number().over(w))

    def schedule_details(self) -> DataFrame:
        """Plan stops: first raw row per (run, line number). One shuffle, by run: grouping, window and storing all use it."""
        li = self.table("lineitem").repartition("l_orderkey")
        first = (li.groupBy("l_orderkey", "l_linenumber")
                 .agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                     "l_discount", "l_tax")).alias("f"))
                 .select("l_orderkey", "l_linenumber", "f.*"))
        w = Window.partitionBy("l_orderkey")
        is_first = F.col("l_linenumber") == F.min("l_linenumber").over(w)
        is_last = F.col("l_linenumber") == F.max("l_linenumber").over(w)
        stop = plan_stop(F.col, F.col("l_orderkey"), is_first, is_last)
        return first.select(F.lit(SCHEDULE_ID).cast("bigint").alias("schedule_id"), F.col("l_orderkey").alias("order_id"),
                            *[c.alias(n) for n, c in stop.items()])

    def operation_details(self) -> DataFrame:
        s = self.stop_raw()
        return s.select(
            F.col("l_orderkey").alias("ophe_id"),
            _run_date(F.col("l_orderkey")).alias("operating_date"),   # denormalized for pruning
            *[c.alias(n) for n, c in executed_stop(F.col, F.col("l_orderkey"), F.col("actual_sequence")).items()])

    # ---- disruptions ----------------------------------------------------
    def _disruption_rows(self) -> DataFrame:
        return self._once("disr", self._disruption_rows0)

    def store_disruption_rows(self, path: str) -> None:
        """Writes the disruption rows, once, so that header and details do not number all stops again for each of them."""
        if "disr" not in self._memo:
            rows = self._disruption_rows0()
            rows.write.mode("overwrite").parquet(path)
            self._memo["disr"] = self.spark.read.parquet(path).select(*rows.columns)

    def _disruption_rows0(self) -> DataFrame:
        s = self.stop_raw().filter(F.col("l_returnflag") == "R")
        p = self.table("part").select("p_partkey", "p_type")
        tax = _tax_pct()
        return (s.join(p, s.l_partkey == p.p_partkey, "inner")
                .select(
                    (F.col("l_orderkey") * 100 + F.col("actual_sequence")).alias("disruption_id"),
                    _run_date(F.col("l_orderkey")).alias("operating_date"),
                    F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), tax.alias("tax_pct"),
                    F.when(tax == 2, F.lit(None).cast("string"))
                     .when(tax == 4, F.lit("ZZ")).otherwise(F.col("p_type")).alias("disruption_type_code"),
                    F.when(tax == 2, F.col("p_type"))
                     .when(tax == 3, F.lit("Utrudnienia w ruchu"))
                     .otherwise(F.concat(F.lit("Komunikat "), F.col("l_orderkey").cast("string")))
                     .alias("message")))

    def disruption_header(self) -> DataFrame:
        d = self._disruption_rows()
        return d.select(
            (F.date_format("operating_date", "yyyyMMdd").cast("bigint") * DISRUPTION_ID_FACTOR
             + F.col("disruption_id")).alias("id"),
            "disruption_type_code", "message",
            F.to_timestamp(F.concat(F.col("operating_date").cast("string"), F.lit(" 08:00:00"))).alias("snapshot_ts"))

    def disruption_details(self) -> DataFrame:
        d = self._disruption_rows()
        return d.select(
            "operating_date",
            F.lit(SCHEDULE_ID).cast("bigint").alias("schedule_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_orderkey").alias("train_order_id"),
            (F.col("l_suppkey") % N_STATIONS).alias("dsta_id"),
            F.col("l_linenumber").alias("sequence_number"),
            (F.date_format("operating_date", "yyyyMMdd").cast("bigint") * DISRUPTION_ID_FACTOR
             + F.col("disruption_id")).alias("dihe_id"))

    # ---- dictionaries ---------------------------------------------------
    def def_city(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").cast("bigint").alias("id"),
                                           F.col("n_name").alias("name"))

    def def_station(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                             F.col("s_nationkey").cast("bigint").alias("dcit_id"))

    def def_carrier(self) -> DataFrame:
        return carriers(self.spark)

    def def_commercial_category(self) -> DataFrame:
        return commercial_categories(self.spark)

    def def_train_status(self) -> DataFrame:
        """Status dictionary as the feed sends it: one entry per status seen."""
        st = self.runs().select(F.col("train_status").alias("code")).distinct()
        names = F.when(F.col("code") == "C", "Zrealizowany").when(F.col("code") == "X", "Odwolany") \
            .when(F.col("code") == "Q", "Skrocony")
        return st.select("code", names.alias("name"))

    def def_disruption_cause(self) -> DataFrame:
        p = self.table("part").select("p_type").distinct()
        return p.select(F.col("p_type").alias("code"),
                        F.concat(F.lit("Utrudnienie ("), F.lower("p_type"),
                                 F.lit("). Na odcinku od stacji {stacja_poczatkowa} do stacji {stacja_koncowa}"))
                        .alias("description"))

    def def_stop_type(self) -> DataFrame:
        return self.spark.createDataFrame([(1, "handlowy"), (2, "techniczny")], "id int, description string")


# Fixed dictionary values of the adapter.
CARRIERS = [
    ("K1", "Przewoznik Pierwszy", "2001-07-25", "2001-07-28"),
    ("K1", "Przewoznik Pierwszy SA", "2001-07-29", OPEN_END),
    ("K2", "Przewoznik Drugi", "2001-07-25", "2001-07-28"),
    ("K2", "Przewoznik Drugi SA", "2001-07-29", OPEN_END),
]
CATEGORIES = [
    ("A", "K1", "Ekspres", "E"), ("B", "K1", "Pospieszny", "P"), ("C", "K1", "Osobowy", "O"),
    ("A", "K2", "Ekspres", "E"), ("B", "K2", "Pospieszny", "P"), ("C", "K2", "Osobowy", "O"),
]
STATUSES = [("C", "Zrealizowany"), ("X", "Odwolany"), ("Q", "Skrocony")]


def carriers(spark: SparkSession) -> DataFrame:
    return (spark.createDataFrame(CARRIERS, "code string, name string, valid_from string, valid_to string")
            .select("code", "name", F.col("valid_from").cast("date").alias("valid_from"),
                    F.col("valid_to").cast("date").alias("valid_to")))


def commercial_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "code string, carrier_code string, name string, speed_category_code string")


def train_statuses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUSES, "code string, name string")
