"""Merkle manifest of a dataset by concatenated-level strings.

Each row is a leaf. Leaves of a source are placed by doc_id and cut into aligned blocks of FAN ** DEPTH. A block keeps
each of its levels as one string of hexadecimal digits (as bytes, so that a cut takes no walk over the string): cutting a
level at fixed widths and hashing the cuts gives the level above, and what flanks a node's digits within its run of FAN
are its siblings. The blocks' top nodes are the leaves of the next round, until each source has one node, its subroot;
the subroots of all sources make the last tree in the same way. Paths go back down from round to round, a row a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.base import stored
from perron.llm.ranks import ranked

#: Nodes that become one node, and levels that a block holds (4,096 leaves, 256 KB of digits).
FAN, DEPTH = 16, 3
#: Hexadecimal digits of a SHA-256.
HEX = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A row is taken as tampered with where this divides the CRC-32 of its decimal doc_id.
TAMPERED = 5

PATH = "array<struct<left:binary,right:binary>>"


def _leaf(text: Column) -> Column:
    """SHA-256 over each field as ``-`` for null, else its UTF-8 length, a colon and its value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[one(text if c == "text" else F.col(c)) for c in FIELDS]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, altered: the leaf that the row gives after tampering (lower-casing A-Z), null where it is the same."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in FIELDS[1:]])
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0) & F.col("text").rlike("[A-Z]")
    return d.select("doc_id", "source", _leaf(F.col("text")).cast("binary").alias("leaf"),
                    F.when(tampered, _leaf(F.translate("text", UPPER, LOWER)).cast("binary")).alias("altered"))


def _above(level: str) -> Column:
    """The level above one, both as bytes of hexadecimal digits."""
    cuts = F.sequence(F.lit(1), F.length(level), F.lit(FAN * HEX))
    return F.array_join(F.transform(cuts, lambda at: F.sha2(F.substring(F.col(level), at, F.lit(FAN * HEX)), 256)), "").cast("binary")


def _flanks(run: Column, at: Column) -> Column:
    """What stands left and right of a node in its run, by its place there."""
    return F.struct(F.substring(run, F.lit(1), at * HEX).alias("left"),
                    F.substring(run, (at + 1) * HEX + 1, F.lit(FAN * HEX)).alias("right"))


def _rounds(nodes: DataFrame, group: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each round, and (group, root) of every group.

    ``nodes``: group, place (from 0, without gaps), size (nodes of the group), node, carried (what a block gives back for
    its members). A block has group, block, size (nodes of the group in this round), levels 0 to DEPTH, top and, in order, what its members carry.
    """
    rounds = []
    while True:
        b = nodes.groupBy(group, F.floor(F.col("place") / FAN**DEPTH).alias("block")).agg(
            F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("place", "node", "carried"))).alias("members"))
        b = b.withColumn("level0", F.array_join(F.transform("members", lambda m: m["node"].cast("string")), "").cast("binary"))
        for k in range(1, DEPTH + 1):
            # a group with no more than FAN ** (k - 1) nodes has reached its root; a block of a larger one goes all the way
            b = b.withColumn(f"level{k}", F.when(F.col("size") > FAN ** (k - 1), _above(f"level{k - 1}")))
        b = b.withColumn("top", F.coalesce(*[F.col(f"level{k}") for k in range(DEPTH, -1, -1)]))
        b = stored(b.withColumn("carried", F.transform("members", lambda m: m["carried"])).drop("members"), "merkle")
        rounds.append(b)
        if (b.agg(F.max("block")).first()[0] or 0) == 0:
            return rounds, b.select(group, F.col("top").alias("root"))
        nodes = b.select(group, F.col("block").alias("place"), F.ceil(F.col("size") / FAN**DEPTH).alias("size"), F.col("top").alias("node"), F.lit(None).cast("string").alias("carried"))


def _paths(rounds: list[DataFrame], group: str, upper: DataFrame) -> DataFrame:
    """group, place, node, carried, path and the columns of ``upper`` for the nodes that :func:`_rounds` was given.

    ``upper``: group, up (the path above the group's root) and further columns. A path lists (left, right) from the node
    to the root. The rounds above the first hold one row for FAN ** DEPTH nodes of the round below.
    """
    more = [c for c in upper.columns if c not in (group, "up")]
    above = upper.select(F.col(group).alias("g"), F.lit(0).cast("long").alias("b"), "up", *more)
    for k, blocks in reversed(list(enumerate(rounds))):
        x = blocks.join(above, F.col(group).eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
        x = x.withColumn("at", F.lit(0).cast("long")).withColumnRenamed("up", "path")
        # down from level to level: a row has its node's stretch of every level below, so no row carries a block's levels
        # to each of its leaves
        for j in range(DEPTH, 0, -1):
            below, has = F.col(f"level{j - 1}"), F.col(f"level{j}").isNotNull()
            nodes = F.when(has, (F.length(below) / HEX).cast("int")).otherwise(1)
            x = x.withColumn("c", F.explode(F.sequence(F.lit(0), nodes - 1)))
            cut = {i: F.substring(f"level{i}", F.col("c") * (FAN ** (j - 1 - i) * HEX) + 1, F.lit(FAN ** (j - 1 - i) * HEX)) for i in range(j)}
            path = F.when(has, F.concat(F.array(_flanks(below, F.col("c"))).cast(PATH), "path")).otherwise(F.col("path"))
            x = x.select(group, "block", (F.col("at") * FAN + F.col("c")).alias("at"), path.alias("path"), *[cut[i].alias(f"level{i}") for i in range(j)],
                         F.slice("carried", F.col("c") * FAN ** (j - 1) + 1, F.lit(FAN ** (j - 1))).alias("carried"), *more)
        x = x.select(group, (F.col("block") * FAN**DEPTH + F.col("at")).alias("place"), F.col("level0").alias("node"), F.col("carried")[0].alias("carried"), "path", *more)
        if k:
            above = x.select(F.col(group).alias("g"), F.col("place").alias("b"), F.col("path").alias("up"), *more)
    return x


def fold(node: Column, path: Column) -> Column:
    """The root that a node (bytes of hexadecimal digits) and its siblings give."""
    return F.aggregate(path, node, lambda n, s: F.sha2(F.concat(s["left"], n, s["right"]), 256).cast("binary"))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of ``docs``.

    A leaf covers doc_id, source, lang, n_chars and text; other columns are ignored. Rows of one source ascend by doc_id
    (null first), then by leaf, so rows that repeat a doc_id have a leaf each and equal rows have equal leaves at places of
    their own. Rows with a null source are a source that comes first; sources are ordered by their UTF-8 bytes. A row with
    a null doc_id is never tampered with. ``folded_root`` folds the leaf, tampered with where TAMPERED says so, with the
    original siblings; ``verified`` says whether that is the root. An empty table has no rows.
    """
    at = ranked(leaves(docs), ["source"], ["doc_id", "leaf"], "place")
    nodes = at.select("source", "place", "size", F.col("leaf").alias("node"), F.struct("doc_id", "altered").alias("carried"))
    rounds, subroots = _rounds(nodes, "source")
    # the tree over the subroots: one group, ordered by source
    top = ranked(subroots.withColumn("all", F.lit(0)), ["all"], ["source"], "place")
    top_rounds, root = _rounds(top.select("all", "place", "size", F.col("root").alias("node"), F.struct("source").alias("carried")), "all")
    none = F.array().cast(PATH)
    top_paths = _paths(top_rounds, "all", root.select("all", none.alias("up"), "root"))
    upper = top_paths.select(F.col("carried.source").alias("source"), F.col("path").alias("up"), F.col("node").alias("subroot"), "root")
    rows = _paths(rounds, "source", upper)
    siblings = F.aggregate("path", F.lit(b""), lambda a, s: F.concat(a, s["left"], s["right"]))
    out = rows.select(F.col("carried.doc_id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                      fold(F.coalesce("carried.altered", "node"), F.col("path")).alias("folded_root"))
    text = [F.col(c).cast("string").alias(c) for c in ("leaf", "subroot", "root")]
    return out.select("doc_id", *text, "proof_sha256", F.col("folded_root").cast("string").alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))
