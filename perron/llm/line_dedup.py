"""Line dedup by winnowing over line hashes.

A text is a sequence of lines that have words. For each line the shortest run of lines from it that holds ``min_words``
words is a window, and the smallest line hash in a window is its fingerprint; neighbouring windows mostly choose the same
line, so fingerprints are few. A passage of that many words that occurs again, from line start to line end, holds whole
windows, and both occurrences choose the same lines of it: only fingerprints that several places have chosen can lie in a
repeated passage, and their positions are joined on the hash. From a shared fingerprint the match is extended both ways
over the line hashes: back to the starts of the windows that chose it, and forward line by line to where the next window
ends. Extents are joined with their first occurrence in the corpus by content, so it does not matter what stands beside
it there, and every line of a later match is deleted. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perron.llm.base import WORD, fresh, stored

MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """doc, key (one for each different row), pos, two hashes and the number of words of each line that has any."""
    lines = docs.select("doc", "key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return (lines.select("doc", "key", "pos", F.xxhash64("line").alias("h"), F.hash("line").alias("h2"),
                         F.regexp_count("line", F.lit(WORD)).alias("words")).where("words > 0"))


def shared_fingerprints(lines: DataFrame) -> DataFrame:
    """Line hashes that are the minimum of windows at several places. ``anew``: a line whose window has another minimum
    than the window before, so a place counts once."""
    return lines.where("anew").groupBy("fp").agg(F.count("*").alias("places")).where("places > 1").select("fp")


def extended(lines: DataFrame) -> DataFrame:
    """doc, key, start, last, fp and two hashes of the content of each extent around a shared fingerprint.

    A text's hashes are one array here, which is smaller than the text, so an extent's content is a slice of it.
    """
    near = lines.where("fp is not null").join(shared_fingerprints(lines), "fp", "left_semi")
    marks = near.groupBy("key").agg(F.min("doc").alias("doc"), F.collect_list(F.struct("seq", "last", "upto", "fp")).alias("marks"))
    hashes = lines.select("key", "seq", "h", "h2").join(marks.select("key"), "key", "left_semi")
    hashes = hashes.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "h", "h2"))), lambda x: F.struct(x["h"], x["h2"])).alias("hashes"))

    def ends(m):
        return F.transform(F.sequence(m["last"], F.greatest(m["last"], m["upto"])), lambda e: F.struct(m["seq"].alias("start"), e.alias("last"), m["fp"].alias("fp")))

    run = lambda x: F.slice("hashes", x["start"], x["last"] - x["start"] + 1)
    each = F.transform("extents", lambda x: F.struct(x["start"].alias("start"), x["last"].alias("last"), x["fp"].alias("fp"), F.xxhash64(run(x)).alias("content"), F.hash(run(x)).alias("content2")))
    return marks.join(hashes, "key").withColumn("extents", F.flatten(F.transform("marks", ends))).select("doc", "key", F.inline(each))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """key, pos of the lines to delete. ``docs``: doc (long), key (long), text, different rows only."""
    order = Window.partitionBy("key").orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    # a row that occurs again gives its lines again: once is enough
    lines = _lines(docs).withColumn("again", F.lag("pos").over(order) == F.col("pos")).where("again is null or not again").drop("again")
    lines = (lines.withColumn("seq", F.row_number().over(order)).withColumn("at", F.coalesce(F.sum("words").over(before), F.lit(0)))
             .withColumn("total", F.sum("words").over(whole)))
    # the lines that start within min_words words from here are the shortest run with so many
    ahead = whole.orderBy("at").rangeBetween(0, min_words - 1)
    lines = lines.withColumn("last", F.max("seq").over(ahead)).withColumn("low", F.min(F.struct("h", "seq")).over(ahead))
    lines = lines.withColumn("last", F.when(F.col("total") - F.col("at") >= min_words, F.col("last")))
    # an extent from here may end with any line before the end of the next window, or of the text
    lines = lines.withColumn("upto", F.coalesce(F.lead("last").over(order) - 1, F.max("seq").over(whole)))
    chosen = F.when(F.col("last").isNotNull(), F.col("low.seq"))
    lines = lines.select("doc", "key", "pos", "seq", "h", "h2", "last", "upto", F.when(F.col("last").isNotNull(), F.col("low.h")).alias("fp"),
                         (~chosen.eqNullSafe(F.lag(chosen).over(order)) & chosen.isNotNull()).alias("anew"))
    lines = stored(lines, "lines")
    extents = stored(extended(lines), "extents")
    same = ["fp", "content", "content2"]
    # an extent's first occurrence
    first = extents.groupBy(*same).agg(F.min(F.struct("doc", "key", "start")).alias("src"), F.count("*").alias("times")).where("times > 1").drop("times")
    match = extents.join(first, same).where((F.col("src.key") != F.col("key")) | (F.col("src.start") < F.col("start")))
    hit = match.select("key", "start", "last")
    # overlapping runs are merged before their lines are listed, so the rows stay within the text's lines
    o = Window.partitionBy("key").orderBy("start", "last")
    reached = F.max("last").over(o.rowsBetween(Window.unboundedPreceding, -1))
    runs = hit.withColumn("from", F.greatest("start", F.coalesce(reached + 1, F.lit(0)))).where("from <= last")
    dead = runs.select("key", F.explode(F.sequence("from", "last")).alias("seq"))
    return dead.join(lines.select("key", "seq", "pos"), ["key", "seq"]).select("key", "pos")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with later repeats of runs of ``min_words`` words or more deleted.

    First is first by doc_id, then place. Lines are compared whole; lines without words count for nothing and
    stay, in a deleted run as well. Null and empty texts pass unchanged. Rows that agree in doc_id and text are one document
    and all keep the same lines; rows with a null doc_id come last. If a text repeats itself with overlap, the lines
    before the first repeat stay. n_chars, if there, follows the text. Adds n_deleted (under a free name if taken).
    """
    key, doc = fresh(docs, "key__"), fresh(docs, "doc__")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    texts = keyed.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    dead = repeated_lines(texts.where(F.col("text").isNotNull()), min_words).groupBy("key").agg(F.collect_set("pos").alias("dead"))
    gone = fresh(docs, "dead__")
    out = keyed.join(dead.select(F.col("key").alias(key), F.col("dead").alias(gone)), key, "left")
    left = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.when(~F.array_contains(F.col(gone), i), x)), lambda x: x.isNotNull())
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    n = fresh(docs, "n_deleted")
    cols = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    out = out.select(*cols, F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.col(gone))).alias(n))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out

