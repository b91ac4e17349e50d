"""A9 across micro-batches: pages of a fetch wait until their snapshot is whole.

Pages are parsed and checked once (A7) and written with the version of the batch that brought them. Of each fetch (run)
only counts and extremes are looked at to decide what it is:

* BAD: a page is no JSON, lacks a required field, or has no timestamp; the whole snapshot is dropped.
* COMPLETE: pages 1..n without gaps, the last of which says that none follows.
* EXPIRED: incomplete, and a run newer by ``EXPIRY`` has arrived. Event time decides, so a replay decides alike.
* PENDING: anything else; its pages are carried to the next batch.

The registry of runs goes with the version as well: pages of a run that is closed are ignored for as long as it is
remembered (``REMEMBERED``); after that they make a run of their own, which the stale gate or the expiry closes again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.operators import shred
from perron.sources.files import PAGE_RE
from perron.sources.schemas import OP_TRAIN, required

EXPIRY, REMEMBERED = dt.timedelta(hours=2), dt.timedelta(days=7)
#: Fixed value: a fetch of more pages is not trusted.
MAX_PAGES = 50
RUN_RE = r"_(\d{14})(?:_p\d+)?\.json$"

PAGES = T.StructType([T.StructField(n, t) for n, t in [
    ("run_key", T.StringType()), ("run_at", T.TimestampType()), ("page", T.IntegerType()), ("object_name", T.StringType()), ("reason", T.StringType()),
    ("has_next", T.BooleanType()), ("generated_at_text", T.StringType()), ("generated_at", T.TimestampType()), ("trains", T.ArrayType(OP_TRAIN))]])
RUNS = "run_key string, run_at timestamp, verdict string, reason string, generated_at timestamp, generated_at_text string"


def page_rows(batch: DataFrame) -> DataFrame:
    """(object_name, payload) -> one row a page with its check; a file without a run timestamp in its name is a run of its own."""
    x = shred.parse(batch, "operations")
    name = F.regexp_extract("object_name", r"([^/]+)$", 1)
    run, page = F.regexp_extract("object_name", RUN_RE, 1), F.regexp_extract("object_name", PAGE_RE, 1)
    stamp = F.try_to_timestamp(F.col("p.generatedAt"))
    reason = (F.when(shred.is_corrupt("p"), "not a JSON object").when(~F.coalesce(required("operations"), F.lit(False)), "required field missing")
              .when(stamp.isNull(), "generatedAt is no timestamp"))
    x = x.select(F.when(run != "", run).otherwise(name).alias("run_key"), F.coalesce(F.try_to_timestamp(F.when(run != "", run), F.lit("yyyyMMddHHmmss")), stamp).alias("run_at"),
                 F.when(page != "", page.cast("int")).otherwise(F.coalesce("p.pagination.page", F.lit(1))).alias("page"), "object_name", reason.alias("reason"),
                 F.coalesce("p.pagination.hasNextPage", F.lit(False)).alias("has_next"), F.col("p.generatedAt").alias("generated_at_text"), stamp.alias("generated_at"),
                 F.when(reason.isNull(), F.col("p.trains")).alias("trains"))
    return x.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAGES.fields])


def gather(new: DataFrame, carried: DataFrame | None, runs: DataFrame | None) -> DataFrame:
    """Pages of runs that are not closed yet; more than one file may bring the same page (see ``first_files``)."""
    new = new.where("run_key is not null and page is not null and object_name is not null")
    if runs is not None:
        new = new.join(runs.where("verdict <> 'PENDING'").select("run_key"), "run_key", "left_anti").select(*PAGES.names)
    return new if carried is None else new.unionByName(carried)


def first_files(pages: DataFrame) -> DataFrame:
    """Of files that bring the same page, the one that is first by name.

    ``pages`` are stored: their names are read alone, and the pages with their trains are shuffled only if a page came twice.
    """
    first = pages.groupBy("run_key", "page").agg(F.min("object_name").alias("object_name"), F.max("object_name").alias("last"))
    if first.where("object_name <> last").isEmpty():
        return pages
    return pages.join(first.drop("last"), ["run_key", "page", "object_name"], "left_semi").select(*PAGES.names)


def verdicts(pages: DataFrame, expiry: dt.timedelta = EXPIRY, max_pages: int = MAX_PAGES) -> DataFrame:
    """RUNS rows of the runs that ``pages`` belong to (see the module's text)."""
    g = pages.groupBy("run_key").agg(
        F.min("run_at").alias("run_at"), F.min("page").alias("lo"), F.max("page").alias("hi"), F.count("*").alias("n"),
        F.min(F.when(F.col("reason").isNotNull(), F.struct("page", "reason"))).alias("bad"),
        F.max(F.struct("page", "has_next")).alias("last"), F.min(F.struct("page", "generated_at", "generated_at_text")).alias("first"))
    newest = g.select(F.max("run_at")).scalar()
    text = F.when(F.col("bad").isNotNull(), F.concat(F.lit("page "), F.col("bad.page"), F.lit(": "), F.col("bad.reason")))
    whole = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & ~F.col("last.has_next")
    late = F.col("run_at") < newest - F.expr(f"INTERVAL {int(expiry.total_seconds())} SECONDS")
    verdict = (F.when(F.col("bad").isNotNull(), "BAD").when(F.col("hi") > max_pages, "BAD").when(whole, "COMPLETE").when(late, "EXPIRED").otherwise("PENDING"))
    why = F.coalesce(text, F.when(F.col("hi") > max_pages, f"more than {max_pages} pages"), F.when((verdict == "EXPIRED"), "pages missing"))
    return g.select("run_key", "run_at", verdict.alias("verdict"), why.alias("reason"), F.col("first.generated_at").alias("generated_at"), F.col("first.generated_at_text").alias("generated_at_text"))


def remembered(old: DataFrame | None, found: DataFrame) -> DataFrame:
    """The registry after a batch: what it decided, and closed runs of before for as long as they are remembered."""
    if old is None:
        return found
    closed = old.where("verdict <> 'PENDING'")
    newest = closed.unionByName(found).select(F.max("run_at")).scalar()
    keep = closed.where(F.coalesce(F.col("run_at") >= newest - F.expr(f"INTERVAL {int(REMEMBERED.total_seconds())} SECONDS"), F.lit(True)))
    return keep.join(found.select("run_key"), "run_key", "left_anti").select(*found.columns).unionByName(found)
