"""Daily gold job: the seven dimensions, daily facts for the recompute window, monthly roll-ups of the touched
months, published together.

Facts are kept by ``month`` (YYYYMM) under one manifest (``operators.layer``): the daily facts rewrite the parts of the
window's months (C7: those months' days outside the window are carried over), the monthly facts those of the touched
months (C8). Parts of other months keep their directories and are neither read nor copied. The pointer is added last
(C13), so a failed run leaves the previous layer current and a rerun is idempotent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.operators import tableops as C
from perron.operators.layer import Load
from perron.plans import gold_dims as D
from perron.plans import gold_facts as G
from perron.plans.silver_model import Silver

DAILY = {"f_train_run_daily": G.run_daily, "f_train_stop_daily": G.stop_daily,
         "f_train_dep_daily": G.dep_daily, "f_train_disruption_daily": G.disruption_daily}
MONTHLY = {"f_train_run_monthly": ("f_train_run_daily", G.run_monthly),
           "f_train_stop_monthly": ("f_train_stop_daily", G.stop_monthly),
           "f_train_dep_monthly": ("f_train_dep_daily", G.dep_monthly),
           "f_train_disruption_monthly": ("f_train_disruption_daily", G.disruption_monthly)}


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", (F.col("date_id") / 100).cast("bigint"))


def run_daily(spark: SparkSession, s: Silver, root: str, as_of: dt.date, days: int = 3) -> str:
    """Run the gold load for ``as_of`` and publish it under ``root``; returns the load's folder."""
    w = G.Window_.days_back(as_of, days)
    lo_d, hi_d = int(w.date_from.strftime("%Y%m%d")), int(w.date_to.strftime("%Y%m%d"))
    lo_m, hi_m = C.month_bounds(w.date_from, w.date_to)
    load = Load(spark, root)  # the published layer, read once; folders of failed runs play no part
    with G.stored(s, w, load.store):
        dimensions = {
            "d_date": D.d_date_covering(s.operation_header, "operating_date"), "d_hour": D.d_hour(spark),
            "d_station": D.d_station(s.def_station, s.def_city), "d_route": D.routes(s.extra["plan_ends"]), "d_train_type": G.train_types(s),
            "d_train_status": D.d_train_status(s.def_train_status), "d_disruption_cause": D.d_disruption_cause(s.def_disruption_cause)}
        for name, df in dimensions.items():
            load.replace(name, df, [])
        for name, fn in DAILY.items():
            new = _with_month(fn(s, w))
            prev = load.table(name, new.schema, (lo_m, hi_m))
            merged = C.recompute_days(prev.select(*new.columns), new, "date_id", lo_d, hi_d)
            load.rewrite_days(name, merged, ["date_id", "month"], "month", (lo_m, hi_m))
    for name, (src, fn) in MONTHLY.items():
        daily = load.table(src, "", (lo_m, hi_m))  # as just written
        monthly = fn(daily.drop("month"))
        load.rewrite_days(name, monthly.filter(F.col("month").between(lo_m, hi_m)), ["month"], "month", (lo_m, hi_m))
    load.publish()    # readers see the new layer only now
    return f"{root}/v={load.version}"
