"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations are sorted by their turns, so that those that share a prefix are neighbours, and each gets the length of the
prefix that it shares with the one before (LCP). A prefix of a shared length is a candidate: from where it occurs, its
first and last member are searched to the left and to the right, each on its own, by halving steps over a sparse table
of minima; no stack is kept and no neighbour's answer is used. The table is laid over ranges of the order: steps within a
range use the range's own table, steps over whole ranges a table of the ranges' minima, and a search that ends in another
range is asked there. Equal answers are one interval of members. All prefixes between an interval's length and the length
that its surroundings share have the same members, and what only one conversation has is its own. The smallest member is a
range minimum over the ids in the same order; sums over subtrees are differences of prefix sums over it.

A conversation is sorted by the places of its stretches of CHUNK turns among all different stretches, so a row holds one
number for CHUNK turns and a long conversation never lies in one row whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.llm.base import shuffle_partitions, stored
from perron.llm.ranks import ranked

#: Fixed values of the rebuilding: a conversation takes the first crc32(id) % HEADS turns of the first of its GROUP ids.
HEADS, GROUP = 9, 5
#: Turns of a stretch, conversations of a range at most or so, and ids hashed as one string.
CHUNK, RANGE, IDS = 512, 1 << 18, 4096


# --- rebuilt conversations

def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, key, bytes) of each rebuilt turn and (conv_id, len) of each conversation, turnless ones too.

    ``key`` is 128 bits of the SHA-256 of role and text, ``bytes`` the UTF-8 length of the text. Rows that agree in
    conv_id and turn are ordered by that hash. Rows with a null conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    t = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                  F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    t = stored(ranked(t, ["conv_id"], ["turn", "key"], "pos", "n").select("conv_id", "pos", "n", "key", "bytes"), "turns")
    c = t.groupBy("conv_id").agg(F.max("n").alias("n"))
    c = c.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    c = c.join(c.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    c = c.withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    c = stored(c.select("conv_id", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    own = t.join(c, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "key", "bytes")
    # a base's first turns go to the few ids that it is the base of
    ids = F.filter(F.sequence(F.col("conv_id") - GROUP + 1, F.col("conv_id") + GROUP - 1), lambda x: x - x % GROUP == F.col("conv_id"))
    first = t.where((F.col("pos") < HEADS - 1) & (F.col("conv_id") % GROUP == 0)).select(F.explode(ids).alias("conv_id"), "pos", "key", "bytes")
    heads = first.join(c, "conv_id").where("pos < h").select("conv_id", "pos", "key", "bytes")
    return stored(own.unionByName(heads), "rebuilt"), c.select("conv_id", "len")


# --- order and common prefixes

def _same_start(a: str, b: str) -> Column:
    """How many leading elements two arrays share."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(at == 0, F.size(a)).otherwise(at - 1).cast("long")


def in_order(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """i (place), part__, n, conv_id, len, ranks, lcp (with the one before; -1 for the first), after (the next one's lcp; -1 for the last)."""
    ranges = max(shuffle_partitions(turns.sparkSession), convs.count() // RANGE)
    pieces = turns.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("j")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "key"))), lambda x: x["key"]).alias("keys"))
    pieces = stored(pieces, "stretches")
    places = stored(ranked(pieces.select("keys").distinct().withColumn("all", F.lit(0)), ["all"], ["keys"], "r", "n").select("keys", "r"), "places")
    rows = pieces.join(places, "keys").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "r"))), lambda x: x["r"]).alias("ranks"))
    rows = convs.join(rows, "conv_id", "left").withColumn("ranks", F.coalesce("ranks", F.array().cast("array<bigint>")))
    s = ranked(rows.withColumn("all", F.lit(0)), ["all"], ["ranks", "conv_id"], "i", "n", ranges).drop("all")
    s = stored(s, "sorted")
    both = s.join(s.select((F.col("i") + 1).alias("i"), F.col("ranks").alias("was"), F.col("len").alias("len0")), "i")
    both = both.select("i", "ranks", "was", "len0", _same_start("ranks", "was").alias("j"))
    at = lambda c: F.get(F.col(c), F.col("j").cast("int"))
    apart = both.where("j < size(ranks) and j < size(was)").select("i", "j", at("ranks").alias("r"), at("was").alias("q"))
    apart = (apart.join(places.select("r", F.col("keys").alias("a")), "r").join(places.select(F.col("r").alias("q"), F.col("keys").alias("b")), "q")
             .select("i", (F.col("j") * CHUNK + _same_start("a", "b")).alias("lcp")))
    lcp = apart.unionByName(both.where("j >= size(was)").select("i", F.col("len0").alias("lcp")))  # the one before is a prefix, or equal
    lcp = stored(lcp, "lcp")
    s = s.join(lcp, "i", "left").join(lcp.select((F.col("i") - 1).alias("i"), F.col("lcp").alias("after")), "i", "left")
    return stored(s.withColumn("lcp", F.coalesce("lcp", F.lit(-1))).withColumn("after", F.coalesce("after", F.lit(-1))), "ordered")


# --- range minima

def sparse_table(x: np.ndarray) -> list[np.ndarray]:
    """Entry i of row k is the minimum of the 2 ** k values from i on."""
    out = [x]
    while 1 << len(out) <= len(x):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def first_below(t: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The first place at or after ``start`` whose value is below ``d``; the length if there is none."""
    at = start.astype(np.int64)
    for k in reversed(range(len(t))):
        some = (at + (1 << k) <= len(t[0])) & (t[k][np.minimum(at, len(t[k]) - 1)] >= d)
        at += some.astype(np.int64) << k
    return at


def last_below(t: list[np.ndarray], start: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The last place at or before ``start`` whose value is below ``d``; -1 if there is none."""
    at = start.astype(np.int64)
    for k in reversed(range(len(t))):
        low = at - (1 << k) + 1
        some = (low >= 0) & (t[k][np.clip(low, 0, len(t[k]) - 1)] >= d)
        at -= some.astype(np.int64) << k
    return at


def minimum(t: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minima of the values from ``lo`` to ``hi``, both included."""
    k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), np.int64)
    for each in np.unique(k):
        m = k == each
        out[m] = np.minimum(t[each][lo[m]], t[each][hi[m] - (1 << int(each)) + 1])
    return out


class _Ranges:
    """First place, smallest lcp and smallest id of each range of the order: a row for RANGE conversations or so."""

    def __init__(self, rows: list) -> None:
        self.part, self.first, size, low, conv = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.last = self.first + size - 1
        self.lcp, self.conv = sparse_table(low), sparse_table(conv)

    def of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, "right") - 1


FIRST, LAST, LEAST = 0, 1, 2
_ASK = "part__ int, kind int, a bigint, b bigint"


def _extents(batches: Iterator[pa.RecordBatch], ranges: _Ranges, n: int) -> Iterator[pa.RecordBatch]:
    """For each place i but the first, the interval of its candidate (i, lcp): left and right, or the range to ask."""
    for batch in batches:
        for part, first, lcps in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            x = np.array(lcps, np.int64)
            me = int(np.searchsorted(ranges.part, part))
            t = sparse_table(x)
            k = np.arange(1 if first == 0 else 0, len(x))
            d = x[k]
            right, left = first_below(t, k + 1, d), last_below(t, k - 1, d)
            to = first_below(ranges.lcp, np.full(len(k), me + 1), d)
            back = last_below(ranges.lcp, np.full(len(k), me - 1), d)  # the first place's lcp of -1 stops every search
            open_right, open_left = (right == len(x)) & (to < len(ranges.part)), left < 0
            end = np.where(right < len(x), first + right - 1, n - 1)
            ask_r, ask_l = ranges.part[np.minimum(to, len(ranges.part) - 1)], ranges.part[np.maximum(back, 0)]
            cols = [pa.array(first + k), pa.array(d), pa.array(first + left, mask=open_left), pa.array(end, mask=open_right),
                    pa.array(ask_l.astype(np.int32), mask=~open_left), pa.array(ask_r.astype(np.int32), mask=~open_right)]
            yield pa.RecordBatch.from_arrays(cols, names=["i", "d", "l", "r", "lp", "rp"])


def _pieces(batches: Iterator[pa.RecordBatch], ranges: _Ranges) -> Iterator[pa.RecordBatch]:
    """What to ask for the smallest id of each interval: in its first range, in its last; whole ranges between are known."""
    for batch in batches:
        l, r = (batch.column(c).to_numpy() for c in (0, 1))
        p, q = ranges.of(l), ranges.of(r)
        mid = np.full(len(l), np.iinfo(np.int64).max)
        far = q - p > 1
        if far.any():
            mid[far] = minimum(ranges.conv, p[far] + 1, q[far] - 1)
        two = q > p
        rows = [(l, r, p, l, np.minimum(r, ranges.last[p]), mid), *([tuple(c[two] for c in (l, r, q, ranges.first[q], r, mid))] if two.any() else [])]
        l, r, p, a, b, mid = (np.concatenate(c) for c in zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(r), pa.array(ranges.part[p].astype(np.int32)), pa.array(a), pa.array(b), pa.array(mid)], names=["l", "r", "part__", "a", "b", "mid"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to what is asked of a range; its own row comes before."""
    first, lcp, conv = 0, [], []
    for batch in batches:
        part, kind, a, b = (batch.column(c).fill_null(0).to_numpy() for c in range(4))
        own = np.flatnonzero(kind < 0)
        out = np.zeros(len(kind), np.int64)
        for lo, hi in zip([-1, *own], [*own, len(kind)], strict=True):
            if lo >= 0:
                first = int(a[lo])
                lcp, conv = (sparse_table(np.array(batch.column(c)[lo].as_py(), np.int64)) for c in (4, 5))
            at = np.arange(lo + 1, hi)
            for k in (FIRST, LAST, LEAST):
                m = at[kind[at] == k]
                if not len(m):
                    continue
                if k == FIRST:
                    out[m] = first + first_below(lcp, np.zeros(len(m), np.int64), a[m])
                elif k == LAST:
                    out[m] = first + last_below(lcp, np.full(len(m), len(lcp[0]) - 1), a[m])
                else:
                    out[m] = minimum(conv, a[m] - first, b[m] - first)
        asked = np.flatnonzero(kind >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(part[asked]), pa.array(kind[asked]), pa.array(a[asked]), pa.array(b[asked]), pa.array(out[asked])], names=["part__", "kind", "a", "b", "answer"])


def _ask(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """part__, kind, a, b, answer of different questions; each range's tables are made once, where its questions go."""
    own = blocks.select("part__", F.lit(-1).alias("kind"), F.col("first").alias("a"), F.lit(0).cast("long").alias("b"), "lcps", "convs")
    none = F.lit(None).cast("array<bigint>")
    dealt = own.unionByName(asked.select("part__", "kind", "a", "b", none.alias("lcps"), none.alias("convs")))
    dealt = dealt.repartition("part__").sortWithinPartitions("part__", "kind")
    return dealt.mapInArrow(_answers, f"{_ASK}, answer bigint")


def intervals(order: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(i, d, l, r) of each place's candidate, and (l, r, d, conv) of the different intervals, the root's among them."""
    blocks = order.groupBy("part__").agg(F.min("i").alias("first"), F.array_sort(F.collect_list(F.struct("i", "lcp", "conv_id"))).alias("rows"))
    blocks = stored(blocks.select("part__", "first", F.col("rows.lcp").alias("lcps"), F.col("rows.conv_id").alias("convs")), "ranges")
    facts = blocks.select("part__", "first", F.size("lcps"), F.array_min("lcps"), F.array_min("convs")).orderBy("first").collect()  # a row for each range
    ranges = _Ranges(facts)
    n = int(ranges.last[-1]) + 1
    found = blocks.select("part__", "first", "lcps").mapInArrow(lambda b: _extents(b, ranges, n), "i bigint, d bigint, l bigint, r bigint, lp int, rp int")
    found = stored(found, "extents")
    zero = F.lit(0).cast("long")
    asked = found.where("rp is not null").select(F.col("rp").alias("part__"), F.lit(FIRST).alias("kind"), F.col("d").alias("a"), zero.alias("b"))
    asked = asked.unionByName(found.where("lp is not null").select(F.col("lp").alias("part__"), F.lit(LAST).alias("kind"), F.col("d").alias("a"), zero.alias("b")))
    said = stored(_ask(blocks, asked.distinct()), "answers")
    right = said.where(F.col("kind") == FIRST).select(F.col("part__").alias("rp"), F.col("a").alias("d"), (F.col("answer") - 1).alias("r2"))
    left = said.where(F.col("kind") == LAST).select(F.col("part__").alias("lp"), F.col("a").alias("d"), F.col("answer").alias("l2"))
    found = found.join(right, ["rp", "d"], "left").join(left, ["lp", "d"], "left")
    found = stored(found.select("i", "d", F.coalesce("l", "l2").alias("l"), F.coalesce("r", "r2").alias("r")), "candidates")
    root = order.sparkSession.range(1).select(zero.alias("l"), F.lit(n - 1).cast("long").alias("r"), zero.alias("d"))
    all_ = found.select("l", "r", "d").unionByName(root).distinct()
    asked = stored(all_.select("l", "r").distinct().mapInArrow(lambda b: _pieces(b, ranges), "l bigint, r bigint, part__ int, a bigint, b bigint, mid bigint"), "pieces")
    said = _ask(blocks, asked.select("part__", F.lit(LEAST).alias("kind"), "a", "b").distinct()).drop("kind")
    conv = asked.join(said, ["part__", "a", "b"]).groupBy("l", "r").agg(F.least(F.min("answer"), F.min("mid")).alias("conv"))
    return found, stored(all_.join(conv, ["l", "r"]), "intervals")


# --- nodes

def _ends(order: DataFrame) -> DataFrame:
    """l, ends_sha256: at the first place of each group of equal conversations, the digest of its ids.

    Ids are joined a block of places at a time and a group's blocks are hashed in order, as a stream.
    """
    some = order.groupBy("ranks", F.floor(F.col("i") / IDS).alias("block")).agg(F.min("i").alias("at"), F.array_sort(F.collect_list(F.struct("i", "conv_id"))).alias("ids"))
    some = stored(some.select("ranks", "at", F.array_join(F.transform("ids", lambda x: x["conv_id"].cast("string")), ",").alias("ids")), "ends")
    groups = some.groupBy("ranks").agg(F.min("at").alias("l"), F.count("*").alias("blocks"))
    of = some.join(groups, "ranks").select("l", "at", "ids", "blocks")
    one = of.where("blocks = 1").select("l", F.sha2("ids", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, h, done = None, None, []
        for b in batches:
            for l, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if l != here:
                    if h:
                        done.append((here, h.hexdigest()))
                    here, h = l, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
        if h:
            done.append((here, h.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], names=["l", "ends_sha256"])

    more = of.where("blocks > 1").select("l", "ids", "at").repartition("l").sortWithinPartitions("l", "at").select("l", "ids")
    return one.unionByName(more.mapInArrow(digest, "l bigint, ends_sha256 string"))


SCHEMA = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def nodes(turns: DataFrame) -> DataFrame:
    """Every node of the trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text; more are ignored).

    Turns ascend by turn (null first); rows that agree in it are ordered by a hash of role and text, and rows that repeat
    are turns too. Null role and text are empty. Rows with a null conv_id are in no conversation. A conversation that the
    rebuilding leaves without turns is a member of the root alone. A table without conversations has no nodes, no root
    either. conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    t, convs = rebuild(turns)
    if not convs.take(1):
        return spark.createDataFrame([], SCHEMA)
    order = in_order(t, convs)
    found, runs = intervals(order)

    # bytes of the turns before each turn, in two levels
    t = t.withColumn("j", F.floor(F.col("pos") / CHUNK))
    inside = Window.partitionBy("conv_id", "j").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    chunks = t.groupBy("conv_id", "j").agg(F.sum("bytes").alias("s"))
    chunks = chunks.select("conv_id", "j", F.coalesce(F.sum("s").over(Window.partitionBy("conv_id").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s0"))
    t = t.withColumn("in", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(chunks, ["conv_id", "j"])
    t = t.join(order.select("conv_id", "i", "lcp"), "conv_id")
    t = stored(t.select("i", "lcp", (F.col("pos") + 1).alias("depth"), "bytes", (F.col("s0") + F.col("in")).alias("before")), "depths")

    # prefix sums over the order: all bytes, bytes of nodes first seen at a place, leaves; in two levels as well
    sums = t.groupBy("i").agg(F.sum("bytes").alias("total"), F.sum(F.when(F.col("depth") > F.col("lcp"), F.col("bytes")).otherwise(0)).alias("new"))
    p = order.drop("ranks", "n").join(sums, "i", "left").fillna(0, ["total", "new"]).withColumn("leaf", (F.col("after") < F.col("len")).cast("long"))
    p = stored(p, "totals")
    what = ["total", "new", "leaf"]
    over_parts = Window.partitionBy(F.lit(0)).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    parts = p.groupBy("part__").agg(*[F.sum(c).alias(c) for c in what])
    parts = parts.select("part__", *[F.coalesce(F.sum(c).over(over_parts), F.lit(0)).alias(f"{c}0") for c in what])
    upto = Window.partitionBy("part__").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    p = p.select("*", *[F.sum(c).over(upto).alias(f"{c}_in") for c in what]).join(parts, "part__")
    p = stored(p.select("i", "conv_id", "len", "lcp", "after", "total", "new", "leaf", *[(F.col(f"{c}0") + F.col(f"{c}_in")).alias(f"{c}_to") for c in what]), "sums")

    # runs of nodes with the same members: shared ones, and what each conversation has alone
    end = p.select(F.col("i").alias("r"), F.col("after").alias("after_r"), *[F.col(f"{c}_to").alias(f"{c}_end") for c in what])
    start = p.select(F.col("i").alias("l"), F.col("lcp").alias("lcp_l"), F.col("len").alias("len_l"), *what, *[f"{c}_to" for c in what])
    shared = runs.join(start, "l").join(end, "r").withColumn("alone", F.lit(False))
    alone = p.where(F.col("len") > F.greatest("lcp", "after", F.lit(0)))
    alone = alone.select(F.col("i").alias("r"), F.col("i").alias("l"), F.col("len").alias("d"), F.col("conv_id").alias("conv"), F.col("lcp").alias("lcp_l"), F.col("len").alias("len_l"),
                         *what, *[f"{c}_to" for c in what], F.col("after").alias("after_r"), *[F.col(f"{c}_to").alias(f"{c}_end") for c in what], F.lit(True).alias("alone"))
    u = shared.unionByName(alone)
    around = F.greatest("lcp_l", "after_r")
    is_root = (F.col("d") == 0) & ~F.col("alone")
    u = u.withColumn("top", F.when(is_root, -1).otherwise(F.greatest(around, F.lit(0))))
    # the run above is the candidate's at the place whose lcp shuts this run in, or else the root's
    u = u.withColumn("shut", F.when(is_root, None).when(around < 0, -1).when(F.col("lcp_l") >= F.col("after_r"), F.col("l")).otherwise(F.col("r") + 1))
    u = u.join(found.select(F.col("i").alias("shut"), F.col("l").alias("pl"), F.col("r").alias("pr"), F.col("d").alias("pd")), "shut", "left")
    last = order.agg(F.max("i")).first()[0]
    to_root = F.col("shut") == -1
    u = u.select("l", "r", "d", "top", "alone", "conv", "lcp_l", "len_l", *what, *[f"{c}_to" for c in what], *[f"{c}_end" for c in what],
                 F.when(to_root, 0).otherwise(F.col("pl")).alias("pl"), F.when(to_root, last).otherwise(F.col("pr")).alias("pr"), F.when(to_root, 0).otherwise(F.col("pd")).alias("pd"))
    u = stored(u, "runs")
    kids = u.where("pl is not null").groupBy(F.col("pl").alias("l"), F.col("pr").alias("r"), F.col("pd").alias("d")).agg(F.count("*").alias("kids")).withColumn("alone", F.lit(False))
    above = runs.select(F.col("l").alias("pl"), F.col("r").alias("pr"), F.col("d").alias("pd"), F.col("conv").alias("above"))
    u = u.join(kids, ["l", "r", "d", "alone"], "left").join(above, ["pl", "pr", "pd"], "left")

    each = u.select("*", F.explode(F.sequence(F.col("top") + 1, "d")).alias("depth"))
    each = each.join(t.select(F.col("i").alias("l"), "depth", "before"), ["l", "depth"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    n = F.col("r") - F.col("l") + 1
    sub = lambda c: F.col(f"{c}_end") - F.col(f"{c}_to") + F.col(c)  # noqa: E731  from l to r
    different = sub("new") - F.col("new") + F.col("total") - F.col("before")
    each = each.join(_ends(order), "l", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return each.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") > F.col("top") + 1, F.col("conv")).otherwise(F.col("above")).alias("parent_conv_id"),
        n.alias("n_convs"),
        F.when(F.col("depth") < F.col("d"), 1).otherwise(F.coalesce("kids", F.lit(0))).cast("long").alias("n_children"),
        sub("leaf").alias("n_leaves"),
        (sub("total") - n * F.col("before") - different).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("len_l"), F.col("ends_sha256")).otherwise(F.lit(empty)).alias("ends_sha256"))
