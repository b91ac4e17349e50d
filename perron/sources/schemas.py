"""Feed payload schemas (StructType per feed) and required-field predicates.

Payloads are parsed wide (timestamps and dates as text) and narrowed when
written (B8): a bad value fails the cast loudly under ANSI mode instead of
being silently truncated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PAGINATION = _st(("page", I), ("pageSize", I), ("totalCount", L), ("totalPages", I), ("hasNextPage", B))

OP_STATION = _st(("stationId", L), ("plannedSequenceNumber", I), ("actualSequenceNumber", I),
                 ("plannedArrival", S), ("plannedDeparture", S), ("actualArrival", S), ("actualDeparture", S), ("arrivalDelayMinutes", I),
                 ("departureDelayMinutes", I), ("isConfirmed", B), ("isCancelled", B))
OP_TRAIN = _st(("scheduleId", L), ("orderId", L), ("trainOrderId", L), ("operatingDate", S),
               ("trainStatus", S), ("stations", T.ArrayType(OP_STATION)))
OPERATIONS = _st(("generatedAt", S), ("pagination", PAGINATION), ("trains", T.ArrayType(OP_TRAIN)))

SCH_STATION = _st(("orderNumber", I), ("stationId", L), ("arrivalTime", S), ("arrivalDay", I),
                  ("arrivalPlatform", S), ("arrivalTrack", S), ("arrivalCommercialCategory", S),
                  ("arrivalTrainNumber", S), ("departureTime", S), ("departureDay", I),
                  ("departurePlatform", S), ("departureTrack", S), ("departureCommercialCategory", S),
                  ("departureTrainNumber", S), ("stopTypeId", I))
SCH_ROUTE = _st(("scheduleId", L), ("orderId", L), ("trainOrderId", L), ("name", S), ("carrierCode", S),
                ("nationalNumber", S), ("internationalArrivalNumber", S), ("internationalDepartureNumber", S),
                ("commercialCategorySymbol", S), ("operatingDates", T.ArrayType(S)),
                ("stations", T.ArrayType(SCH_STATION)))
SCHEDULES = _st(("generatedAt", S), ("routes", T.ArrayType(SCH_ROUTE)))

AFFECTED = _st(("scheduleId", L), ("orderId", L), ("trainOrderId", L), ("operatingDate", S),
               ("stationId", L), ("sequenceNumber", I))
DISRUPTION = _st(("disruptionId", L), ("disruptionTypeCode", S), ("message", S),
                 ("affectedRoutes", T.ArrayType(AFFECTED)))
DISRUPTIONS = _st(("generatedAt", S), ("disruptions", T.ArrayType(DISRUPTION)))

CARRIERS = _st(("carriers", T.ArrayType(_st(("code", S), ("name", S), ("validFrom", S), ("validTo", S)))))
CITIES = _st(("cities", T.ArrayType(_st(("name", S), ("stationCount", I), ("stationIds", T.ArrayType(L))))))
STATIONS = _st(("generatedAt", S), ("stations", T.ArrayType(_st(("id", L), ("name", S)))))
CATEGORIES = _st(("generatedAt", S), ("commercialCategories", T.ArrayType(
    _st(("code", S), ("name", S), ("carrierCode", S), ("speedCategoryCode", S)))))
STOP_TYPES = _st(("generatedAt", S), ("stopTypes", T.ArrayType(_st(("id", I), ("description", S)))))
TRAIN_STATUSES = _st(("trainStatuses", T.MapType(S, S)))
DISRUPTION_TYPES = _st(("generatedAt", S), ("disruptionTypes", T.MapType(S, S)))

DELTA_ROW = _st(("scheduleId", L), ("orderId", L), ("trainOrderId", L), ("operatingDate", S), ("stationId", L),
                ("sequenceNumber", I), ("disruptionTypeCode", S), ("message", S), ("changeHash", S))
DISRUPTIONS_DELTA = _st(("generatedAt", S), ("changed", T.ArrayType(DELTA_ROW)), ("ended", T.ArrayType(DELTA_ROW)))

FEEDS: dict[str, T.StructType] = {
    "operations": OPERATIONS, "schedules": SCHEDULES, "disruptions": DISRUPTIONS, "carriers": CARRIERS,
    "cities": CITIES, "stations": STATIONS, "commercial_categories": CATEGORIES, "stop_types": STOP_TYPES,
    "train_statuses": TRAIN_STATUSES, "disruption_types": DISRUPTION_TYPES,
    "disruptions_delta": DISRUPTIONS_DELTA,
}


def _all(arr: str, pred) -> Column:
    """Every element satisfies ``pred`` (a null or empty array passes)."""
    return F.coalesce(F.forall(F.col(arr), pred), F.lit(True))


def _nn(*names):
    return lambda x: _and([x[n].isNotNull() for n in names])


def _and(cs):
    out = F.lit(True)
    for c in cs:
        out = out & c
    return out


# Required fields per feed (JSON Schema "required"); extra fields are allowed.
REQUIRED: dict[str, Column] = {}


def required(feed: str, root: str = "p") -> Column:
    """Predicate over the parsed struct column ``root``: all required fields present."""
    r = F.col(root)
    if feed == "operations":
        return _and([r["generatedAt"].isNotNull(), r["pagination"].isNotNull(), r["trains"].isNotNull(),
                     F.forall(r["trains"], lambda t: _and([
                         t["scheduleId"].isNotNull(), t["orderId"].isNotNull(), t["trainOrderId"].isNotNull(),
                         t["operatingDate"].isNotNull(), t["stations"].isNotNull(),
                         F.forall(t["stations"], _nn("stationId", "plannedSequenceNumber",
                                                     "actualSequenceNumber"))]))])
    if feed == "schedules":
        return _and([r["generatedAt"].isNotNull(), r["routes"].isNotNull(),
                     F.forall(r["routes"], lambda t: _and([
                         t["scheduleId"].isNotNull(), t["orderId"].isNotNull(), t["trainOrderId"].isNotNull(),
                         t["carrierCode"].isNotNull(), t["nationalNumber"].isNotNull(),
                         t["commercialCategorySymbol"].isNotNull(), t["operatingDates"].isNotNull(),
                         t["stations"].isNotNull(), F.forall(t["stations"], _nn("orderNumber", "stationId"))]))])
    if feed == "disruptions":
        return _and([r["generatedAt"].isNotNull(), r["disruptions"].isNotNull(),
                     F.forall(r["disruptions"], lambda d: _and([
                         d["disruptionId"].isNotNull(), d["message"].isNotNull(), d["affectedRoutes"].isNotNull(),
                         F.forall(d["affectedRoutes"], _nn("scheduleId", "orderId", "operatingDate", "stationId",
                                                           "sequenceNumber"))]))])
    if feed == "carriers":
        return r["carriers"].isNotNull() & F.forall(r["carriers"], _nn("code", "name", "validFrom", "validTo"))
    if feed == "cities":
        return r["cities"].isNotNull() & F.forall(r["cities"], _nn("name", "stationCount", "stationIds"))
    if feed == "stations":
        return r["generatedAt"].isNotNull() & r["stations"].isNotNull() & F.forall(r["stations"], _nn("id", "name"))
    if feed == "commercial_categories":
        return (r["generatedAt"].isNotNull() & r["commercialCategories"].isNotNull()
                & F.forall(r["commercialCategories"], _nn("code", "name", "carrierCode", "speedCategoryCode")))
    if feed == "stop_types":
        return r["generatedAt"].isNotNull() & r["stopTypes"].isNotNull() & F.forall(r["stopTypes"],
                                                                                    _nn("id", "description"))
    if feed == "train_statuses":
        return r["trainStatuses"].isNotNull() & (F.size(r["trainStatuses"]) >= 1)
    if feed == "disruption_types":
        return r["generatedAt"].isNotNull() & r["disruptionTypes"].isNotNull() & (F.size(r["disruptionTypes"]) >= 1)
    raise KeyError(feed)
