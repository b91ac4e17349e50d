"""Near-duplicate embeddings by a forest of random-projection trees.

Equal vectors are one class. A tree splits its vectors by random projections again and again; what lies near a split's
threshold goes to both sides (spill), so that similar vectors part seldom in one tree and hardly ever in all.
Thresholds are set where fewest vectors spill. Splits are fitted on bounded samples, but every vector is dealt out, and
leaves that come out too large are split again on samples of their own. Within leaves all vectors are compared in double
precision. Each pair is counted in the first leaf that both share, so no pairs leave a leaf: only numbers of links and a
spanning forest of them.

Dense groups would spill everywhere and make all their pairs. Vectors closer to a leader than half the angle allowed are
all linked to each other: such a core is counted by its size and stays out of the forest; who lies near it without
belonging to it is compared with its members in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import small_batches, stored
from perron.llm.components import components

#: Node ids: the tree above TREE_BIT, FINAL for a leaf that no split makes smaller, the place in the tree below it.
TREE_BIT, FINAL = 56, 1 << 55


class Forest(NamedTuple):
    """Least cosine of a link; trees, vectors that a leaf should hold, half width of the spill as a share of the expected
    difference of linked vectors; vectors that splits and leaders are fitted on (per round and node to be split), the least
    of them in a split, and levels that one round adds below the first; vectors in a block of a comparison, and vectors of
    the sample that make a leader's core a dense group."""

    similar: float = 0.9
    trees: int = 6
    leaf: int = 512
    spill: float = 0.5
    sample: int = 8192
    least: int = 32
    levels: int = 6
    block: int = 1024
    dense: int = 8

    def width(self, dim: int) -> float:
        return self.spill * math.sqrt((2 - 2 * self.similar) / dim)

    @property
    def core(self) -> float:
        """Cosine to a leader from which on two vectors are linked in any case."""
        return math.sqrt((1 + self.similar) / 2)


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _direction(node: int, dim: int) -> np.ndarray:
    v = np.random.Generator(np.random.PCG64([node, dim])).standard_normal(dim)
    return v / np.sqrt(v @ v)


def fit(x: np.ndarray, root: int, size: int, levels: int, o: Forest) -> dict[int, float]:
    """Thresholds of the splits below ``root`` by node, from a sample ``x`` of its ``size`` vectors; NaN where none helps."""
    out, todo = {}, [(root, np.arange(len(x)), 0)]
    w = o.width(x.shape[1])
    while todo:
        node, rows, depth = todo.pop()
        if len(rows) * size <= o.leaf * len(x) or len(rows) < 2 * o.least or depth == levels:
            continue
        p = x[rows] @ _direction(node, x.shape[1])
        s = np.sort(p)
        # between the quarters, where fewest spill
        at = s[np.linspace(len(s) // 4, 3 * len(s) // 4, 33).astype(int)]
        at = (at + s[np.minimum(np.searchsorted(s, at, "right"), len(s) - 1)]) / 2
        spilled = np.searchsorted(s, at + w, "right") - np.searchsorted(s, at - w)
        t = float(at[np.lexsort((np.abs(np.arange(33) - 16), spilled))[0]])
        left, right = rows[p <= t + w], rows[p >= t - w]
        if max(len(left), len(right)) > 0.9 * len(rows):
            out[node] = math.nan
            continue
        out[node] = t
        base, place = node >> TREE_BIT << TREE_BIT, node & (FINAL - 1)
        todo += [(base | 2 * place, left, depth + 1), (base | 2 * place + 1, right, depth + 1)]
    return out


def route(x: np.ndarray, root: int, splits: dict[int, float], o: Forest) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves below ``root`` and the rows of ``x`` that lie in each."""
    w = o.width(x.shape[1])
    todo = [(root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        t = splits.get(node)
        if not len(rows):
            continue
        if t is None or math.isnan(t):
            yield (node if t is None else node | FINAL), rows
            continue
        p = x[rows] @ _direction(node, x.shape[1])
        base, place = node >> TREE_BIT << TREE_BIT, node & (FINAL - 1)
        todo += [(base | 2 * place, rows[p <= t + w]), (base | 2 * place + 1, rows[p >= t - w])]


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _lists(rows: list[np.ndarray], of: list[int], n: int) -> pa.Array:
    """An array of lists: place ``k`` of ``of`` says what the members ``rows[k]`` get; at least one list a row."""
    who = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    what = np.repeat(np.array(of, np.int64), [len(r) for r in rows])
    order = np.lexsort((what, who))
    ends = np.searchsorted(who[order], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(what[order]))


# --- classes of equal vectors

def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each usable vector; null for others."""
    for b in batches:
        hi, lo, dim = [], [], []
        for v in b.column(2):
            x = np.array([math.nan], float) if not v.is_valid else np.array(v.as_py(), float)
            if not len(x) or not np.isfinite(x).all() or not x.any():
                hi.append(None), lo.append(None), dim.append(None)
                continue
            d = xxhash.xxh3_128_intdigest((x + 0.0).tobytes())
            hi.append((d >> 64) - (1 << 63)), lo.append((d & (2**64 - 1)) - (1 << 63)), dim.append(len(x))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(dim, pa.int32())], names=["row", "vec_id", "v", "hi", "lo", "dim"])


def _sample(rows: DataFrame, n: int, most: int) -> DataFrame:
    """``most`` rows or so of ``n``, by a hash of their class."""
    return rows if n <= most else rows.where(F.pmod(F.xxhash64("cid", F.lit(0)), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def _leaders(x: np.ndarray, o: Forest) -> np.ndarray:
    """Vectors of the sample that are no closer to each other than a core's radius and have ``dense`` so near."""
    kept = []
    left = np.ones(len(x), bool)
    for i in range(len(x)):
        if not left[i]:
            continue
        ball = left & (x @ x[i] >= o.core)
        if ball.sum() >= o.dense:
            kept.append(x[i])
            left &= ~ball
    return np.array(kept).reshape(-1, x.shape[1])


# --- comparison in leaves and blocks

def _pairs(x: np.ndarray, side: np.ndarray, both: bool, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) with a cosine of ``similar`` or more: all pairs, or those of different sides."""
    left, right = (np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())) if both else (np.arange(len(x)),) * 2
    found = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(left), 512):
        a = left[at : at + 512]
        i, j = np.nonzero(x[a] @ x[right].T >= similar)
        i, j = a[i], right[j]
        ok = slice(None) if both else i < j
        found.append((i[ok], j[ok]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _first_here(i: np.ndarray, j: np.ndarray, leaf: int, at: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Which pairs share no leaf before ``leaf``. Row k's leaves are those from at[k] to at[k + 1]."""
    who = np.repeat(np.arange(len(at) - 1), np.diff(at))
    linked = np.zeros(len(at) - 1, bool)
    linked[i] = linked[j] = True
    some = (leaves < leaf) & linked[who]
    names, code, times = np.unique(leaves[some], return_inverse=True, return_counts=True)
    more = times > 1
    code, who = (np.cumsum(more) - 1)[code][more[code]], who[some][more[code]]
    out = np.ones(len(i), bool)
    for w in range(0, int(more.sum()), 64):
        bits = np.zeros(len(at) - 1, np.uint64)
        m = (code >= w) & (code < w + 64)
        np.bitwise_or.at(bits, who[m], np.uint64(1) << (code[m] - w).astype(np.uint64))
        out &= (bits[i] & bits[j]) == 0
    return out


def _trees_of(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least row that each of ``n`` rows is linked to, by way of others or itself."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low), np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low), np.minimum.at(root, before[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _compare(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """cid, links (weight of the partners) and root (another class that it is linked with) of each block's classes."""
    rest: list[pa.RecordBatch] = []

    def close(t: pa.Table, lo: int, hi: int) -> pa.RecordBatch | None:
        t = t.slice(lo, hi - lo).combine_chunks()
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        cid, w, side = (col[c].to_numpy() for c in ("cid", "w", "side"))
        both = col["i"][0].as_py() != col["j"][0].as_py()
        if len(cid) < 2 or (both and side.min() == side.max()):
            return None
        i, j = _pairs(units(_matrix(col["v"])), side, both, similar)
        if not len(i):
            return None
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(col["leaves"]).to_numpy())])
        new = _first_here(i, j, col["leaf"][0].as_py(), at, col["leaves"].flatten().to_numpy())
        n = np.zeros(len(cid), np.int64)
        np.add.at(n, i[new], w[j[new]]), np.add.at(n, j[new], w[i[new]])
        root = _trees_of(i, j, len(cid))
        some = np.flatnonzero((n > 0) | (root != np.arange(len(cid))))
        return pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(n[some]), pa.array(cid[root[some]])], names=["cid", "links", "root"])

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*rest, b])
        key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("dim", "leaf", "i", "j")])
        edges = [0, *(1 + np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0))), t.num_rows]
        for lo, hi in zip(edges[:-2], edges[1:-1], strict=True):
            if (out := close(t, lo, hi)) is not None:
                yield out
        rest = t.slice(edges[-2]).to_batches()
    if rest:
        t = pa.Table.from_batches(rest)
        if (out := close(t, 0, t.num_rows)) is not None:
            yield out


def _dealt(rows: DataFrame, o: Forest) -> DataFrame:
    """cid, links, root by comparing what shares (dim, leaf, i, j)."""
    cols = ["dim", "leaf", "i", "j", "side", "cid", "w", "v", "leaves"]
    return rows.select(*cols).repartition("dim", "leaf", "i", "j").sortWithinPartitions("dim", "leaf", "i", "j").mapInArrow(lambda b: _compare(b, o.similar), "cid bigint, links bigint, root bigint")


def _blocks(rows: DataFrame, size: str, block: int) -> DataFrame:
    """``rows`` of a leaf of ``size`` vectors in blocks, each given to every pair of blocks that it is in."""
    n = F.ceil(F.col(size) / block).cast("int")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("cid"), n).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.withColumn("i", F.least("side", "o")).withColumn("j", F.greatest("side", "o"))


# --- the operator

def _again(rows: DataFrame, o: Forest) -> DataFrame:
    """``rows`` (cid, w, v, dim, leaves) with oversized leaves split further, a round at a time."""
    turn = 0
    while True:
        turn += 1
        each = rows.select("cid", "v", "dim", F.explode("leaves").alias("leaf"))
        large = each.where(F.col("leaf").bitwiseAND(F.lit(FINAL)) == 0).groupBy("dim", "leaf").agg(F.count("*").alias("size")).where(F.col("size") > 4 * o.leaf)
        large = stored(large, "large")
        if not large.take(1):
            return rows
        of = each.join(large, ["dim", "leaf"])
        some = of.where(F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(1 << 30)) * F.col("size") < F.lit(o.sample).cast("double") * (1 << 30))

        def splits(df: pd.DataFrame) -> pd.DataFrame:
            leaf, dim, size = int(df["leaf"].iloc[0]), int(df["dim"].iloc[0]), int(df["size"].iloc[0])
            got = fit(units(np.stack(df["v"].to_list())), leaf, size, o.levels, o) or {leaf: math.nan}
            return pd.DataFrame({"dim": [dim], "leaf": [leaf], "nodes": [list(got)], "at": [list(got.values())]})

        models = some.groupBy("dim", "leaf").applyInPandas(splits, "dim int, leaf bigint, nodes array<bigint>, at array<double>")
        models = stored(models, "splits")

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf, dim = b.column(1).to_numpy(), b.column(2).to_numpy()
                rows, ids = [], []
                for d, l in np.unique(np.stack([dim.astype(np.int64), leaf]), axis=1).T:
                    mine = np.flatnonzero((dim == d) & (leaf == l))
                    # pandas turns NaN into null on its way to Arrow
                    t = {n: math.nan if at is None else at for n, at in zip(b.column(4)[mine[0]].as_py(), b.column(5)[mine[0]].as_py(), strict=True)}
                    for node, got in route(units(_matrix(b.column(3).take(pa.array(mine)))), int(l), t, o):
                        rows.append(mine[got]), ids.append(node)
                yield pa.RecordBatch.from_arrays([b.column(0), _lists(rows, ids, b.num_rows)], names=["cid", "leaves"])

        split = of.select("dim", "leaf", "cid", "v").join(models, ["dim", "leaf"]).select("cid", "leaf", "dim", "v", "nodes", "at")
        split = split.repartition("leaf", F.pmod(F.xxhash64("cid"), F.lit(64))).sortWithinPartitions("leaf")
        new = split.mapInArrow(deal, "cid bigint, leaves array<bigint>").select("cid", F.explode("leaves").alias("leaf"))
        old = each.join(models.select("dim", "leaf"), ["dim", "leaf"], "left_anti").select("cid", "leaf")
        leaves = old.unionByName(new).groupBy("cid").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
        rows = stored(rows.drop("leaves").join(leaves, "cid"), "forest")


def near_duplicates(vectors: DataFrame, o: Forest = Forest()) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding; other columns are ignored).

    Two vectors are linked if their cosine, in double precision, is ``similar`` or more. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, as do vectors of different lengths. n_links is the number of
    other vectors linked directly; rows that repeat a vec_id and its vector are one vector, those that repeat a vec_id with
    another vector are vectors of their own in one component. component_id is the least vec_id reachable, kept says whether
    that is the row's own. A row with a null vec_id has no links, component null, and is kept. An empty table gives none.
    """
    spark = vectors.sparkSession
    src = small_batches(vectors).select("vec_id", "embedding").select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    kind = src.schema["v"].dataType.simpleString()
    prep = stored(src.mapInArrow(_prepare, f"row bigint, vec_id bigint, v {kind}, hi bigint, lo bigint, dim int"), "vectors")
    usable = prep.where("hi is not null and vec_id is not null")
    ids = usable.groupBy("hi", "lo", "vec_id").agg(F.min("row").alias("row"))
    classes = stored(ids.groupBy("hi", "lo").agg(F.min("row").alias("cid"), F.min("vec_id").alias("least"), F.count("*").alias("w")), "classes")
    reps = stored(prep.join(classes.select(F.col("cid").alias("row"), "cid", "w"), "row").select("cid", "w", "v", "dim"), "representatives")
    sizes = {r["dim"]: r["n"] for r in reps.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each vector length

    sample = _sample(reps, sum(sizes.values()), o.sample).orderBy("cid").toPandas()  # ``sample`` rows or so
    models = {}
    for dim, part in sample.groupby("dim"):
        x = units(np.stack(part["v"].to_list()))
        lead = _leaders(x, o)
        light = x[(x @ lead.T < o.core).all(1)] if len(lead) else x
        splits = {}
        for tree in range(o.trees):
            splits |= fit(light, tree << TREE_BIT | 1, max(1, round(sizes[dim] * len(light) / len(x))), 40, o)
        models[int(dim)] = (lead, splits)
    shared = spark.sparkContext.broadcast(models)
    half, wide = o.core + 1e-6, math.cos(1.5 * math.acos(o.similar)) - 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(3).to_numpy()
            core = np.full(len(dims), -1, np.int32)
            near, of, rows, ids = [], [], [], []
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                x = units(_matrix(b.column(2).take(pa.array(mine))))
                lead, splits = shared.value.get(int(d), (np.zeros((0, int(d))), {}))
                if len(lead):
                    c = x @ lead.T
                    core[mine] = np.where(c.max(1) >= half, c.argmax(1), -1)
                    for k in range(len(lead)):
                        # of two cores the one with the lower number asks the other
                        near.append(mine[(c[:, k] >= wide) & (core[mine] < k)]), of.append(k)
                light = np.flatnonzero(core[mine] < 0)
                for tree in range(o.trees):
                    for leaf, got in route(x[light], tree << TREE_BIT | 1, splits, o):
                        rows.append(mine[light[got]]), ids.append(leaf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(core), _lists(near, of, len(dims)), _lists(rows, ids, len(dims))], names=["cid", "w", "v", "dim", "core", "near", "leaves"])

    placed = stored(reps.mapInArrow(place, f"cid bigint, w bigint, v {kind}, dim int, core int, near array<bigint>, leaves array<bigint>"), "placed")

    # cores: by their sizes, and in blocks with what lies near
    cores = placed.where("core >= 0").groupBy("dim", "core").agg(F.sum("w").alias("weight"), F.count("*").alias("size"), F.min("cid").alias("root"))
    cores = stored(cores, "cores")  # as many as leaders at most
    inside = placed.where("core >= 0").select("dim", "core", "cid", "w").join(cores, ["dim", "core"]).select("cid", (F.col("weight") - F.col("w")).alias("links"), "root")
    asks = placed.select("dim", F.explode("near").alias("core"), "cid", "w", "v").withColumn("core", F.col("core").cast("int"))
    asked = stored(asks.groupBy("dim", "core").agg(F.count("*").alias("asks")).join(cores.select("dim", "core", "size"), ["dim", "core"]), "asked")
    nb, nq = F.ceil(F.col("size") / o.block).cast("int"), F.ceil(F.col("asks") / o.block).cast("int")
    none = F.array().cast("array<bigint>")
    # i counts blocks of members, j - BIG blocks of those who ask: i and j never agree
    big = 1 << 20
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = placed.where("core >= 0").select("dim", "core", "cid", "w", "v").join(asked, ["dim", "core"])
    own = own.select("dim", F.col("core").cast("long").alias("leaf"), "cid", "w", "v", F.pmod(F.xxhash64("cid"), nb).cast("int").alias("i"), each(nq).alias("j"), F.lit(0).alias("side"))
    who = asks.join(asked, ["dim", "core"]).select("dim", F.col("core").cast("long").alias("leaf"), "cid", "w", "v", F.pmod(F.xxhash64("cid"), nq).cast("int").alias("j"), each(nb).alias("i"), F.lit(1).alias("side"))
    grid = own.unionByName(who).withColumn("j", F.col("j") + big).withColumn("leaves", none)
    across = _dealt(grid, o)

    # the forest
    forest = _again(placed.where("core < 0").select("cid", "w", "v", "dim", "leaves"), o)
    rows = forest.select("*", F.explode("leaves").alias("leaf"))
    wide_leaves = forest.select("dim", F.explode("leaves").alias("leaf")).groupBy("dim", "leaf").agg(F.count("*").alias("size")).where(F.col("size") > o.block)
    rows = rows.join(stored(wide_leaves, "wide"), ["dim", "leaf"], "left").withColumn("size", F.coalesce("size", F.lit(1)))
    within = _dealt(_blocks(rows, "size", o.block), o)

    found = stored(inside.unionByName(across).unionByName(within), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    of = stored(ids.drop("row").join(classes, ["hi", "lo"]).select("hi", "lo", "vec_id", "cid", "least"), "members")
    tied = of.groupBy("vec_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z")
    tied = of.join(tied, "vec_id").select(F.col("cid"), F.col("a").alias("root"))
    edges = found.select("cid", "root").unionByName(tied).where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b"))
    roots = components(edges)
    facts = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = facts.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = facts.join(least, "root").join(links, "cid", "left").select("hi", "lo", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = prep.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("hi")).alias("hi"), "lo").join(facts, ["hi", "lo"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
