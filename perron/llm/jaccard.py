"""N-gram Jaccard join by PartEnum signatures.

Sets are put into size bands so that two sets that are similar enough lie in one band or in neighbours; each set signs
for its own band and the next. In a band all sets differ from a similar one in at most k elements. The feature domain is
hashed into k // 2 + 1 first-level partitions, one of which holds at most one of these differences, and each of them into
two second-level cells; leaving out either, the other cell of some partition is equal in both sets, so similar sets share
at least one signature. No link is lost. A cell that holds nothing gets a second key, so unrelated sets do not meet there.

Equal sets are one class with one representative. Signatures that several classes share give candidates: first each
class with the smallest of the group (a star, never all pairs of a group). These are verified and joined into
components. Only groups whose members still lie in different components are compared further, in blocks of bounded
size, where a bitmap of element parities gives a lower bound of the difference and drops most pairs unseen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.llm.base import mix64, per_text, stored, text_or_empty
from perron.llm.components import components

#: Similarity as num / den, and words in a shingle.
NUM, DEN, SHINGLE = 90, 100, 3
#: Share of the sets of a band that may meet without having an element in common, deals at most, and thin cells of a set
#: (on average) up to which there are more deals than one.
CHANCE, DEALS, THIN = 1e-6, 12, 0.6
#: Members of a group that one block holds; bits in the bitmap of wanted documents for each of them, and wanted documents
#: beyond which (a bitmap of 64 MB) texts are joined with them instead.
BLOCK, WANTED_BITS, WANTED = 512, 8, 1 << 26
#: Pairs looked at and 64-bit words of bitmaps compared at once.
PAIRS, WORDS = 1 << 18, 1 << 20
#: Classes of copies that every task knows, and documents signed at once.
COPIED, SIGN = 10_000, 256
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles; fewer words make one, none makes none."""
    words = raw.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        acc = mix64(acc * _GOLD + h[i : i + len(acc)])
    return np.unique(acc)


@lru_cache(maxsize=None)
def bands(num: int, den: int, upto: int = 1 << 40) -> np.ndarray:
    """Least sizes of the bands: a set in one is similar only to sets of this and the neighbouring bands."""
    out = [1]
    while out[-1] <= upto:
        out.append(den * out[-1] // num + 1)
    return np.array(out, np.int64)


def signatures(x: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """PartEnum signatures of a set of hashes, for its own band and the next.

    A band in which similar sets have to be equal needs none: equal sets are one class.
    """
    low = bands(num, den)
    own = int(np.searchsorted(low, len(x), "right")) - 1
    out = [np.zeros(0, np.uint64)]
    for band in (own, own + 1):
        # sizes here are below low[band + 1]; hamming distance <= (den - num) / (den + num) * (sum of sizes)
        k = (den - num) * 2 * (int(low[band + 1]) - 1) // (den + num)
        if k:
            out.append(_enumerated(x, band, k, 0, int(low[max(band - 1, 0)])))
    return np.concatenate(out)


@lru_cache(maxsize=None)
def _deals(least: int, first: int) -> int:
    """Deals for a band whose sets have ``least`` elements or more: until hardly a set is thin in all of them.

    One only where a set is thin in so many partitions that the deals would multiply its signatures (large sets at low
    similarities); there sets that are thin in the same cell meet, some 1 % of a band, and are told apart by comparing.
    """
    q = 1 / (2 * first)
    thin = (1 - q) ** least * ((1 - q) ** least + least * q * (1 - q) ** (least - 1))
    if 2 * first * thin > THIN:
        return 1
    return min(DEALS, math.ceil(math.log(CHANCE) / math.log(min(thin, 0.5))))


def _enumerated(x: np.ndarray, band: int, k: int, deal: int, least: int) -> np.ndarray:
    """Signatures of one band, whose sets have ``least`` elements or more, by deal ``deal`` of the features.

    Of each first-level partition one of two cells is kept, as similar sets differ in one element there at most. A
    cell that holds nothing says nothing of its set, and unrelated sets would meet in it. But then the whole difference
    lies in the other cell, so this one's content is a key, whole and with each element left out. Where it holds no
    more than one element, the second key is each signature of the next deal, an independent one: similar sets share one
    of those whatever they share in the first. So no link is lost. The band alone decides how many deals there are.
    """
    first = k // 2 + 1
    mixed = mix64(x + np.uint64(int(_GOLD) * (2 * deal + 1) % 2**64))
    at = (((x if not deal else mixed) >> np.uint64(20)) % np.uint64(first * 2)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    mixed = mixed[order]
    edges = np.searchsorted(at[order], np.arange(first * 2 + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    cell = total[edges[1:]] - total[edges[:-1]]  # sums of hashes, modulo 2**64
    held = np.diff(edges)
    tag = mix64((np.arange(first * 2, dtype=np.uint64) + np.uint64(band << 40) + np.uint64((deal << 60) % 2**64)) * _GOLD)
    out, thin = [mix64(tag * _GOLD + cell)[held > 0]], []
    for c in np.flatnonzero(held == 0):
        o = c ^ 1
        sums = cell[o : o + 1] if held[o] == 1 else np.concatenate([cell[o : o + 1], cell[o] - mixed[edges[o] : edges[o + 1]]])
        if held[o]:
            out.append(mix64(mix64(tag[c : c + 1] + np.uint64(1)) * _GOLD + sums))
        if held[o] <= 1:
            thin.append(c)
    if thin:
        keys = mix64(tag[thin] + np.uint64(2))
        if deal + 1 < _deals(least, first):
            second = _enumerated(x, band, k, deal + 1, least)
            keys = mix64(keys[:, None] * _GOLD + second[None, :]).ravel()
        out.append(keys)
    return np.concatenate(out)


def sketch(x: np.ndarray) -> np.ndarray:
    """A bitmap of about one to two bits for each element, a power of two of 64-bit words: bit i is the parity of the
    elements that hash to i. Two sets' bitmaps of one width differ in no more bits than the sets differ in elements,
    and a bitmap is folded to half its width by XOR of its halves."""
    bits = 64 << max(2, (len(x) // 64).bit_length())
    odd = np.bincount(((x >> np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows x words) folded to ``width`` words."""
    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), axis=1)


def _digest(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed longs."""
    d = xxhash.xxh3_128_intdigest(x.tobytes())
    return (d >> 64) - (1 << 63), (d & (2**64 - 1)) - (1 << 63)


def _prepare(texts: list[bytes], ngram: int) -> list[pa.Array]:
    sets = [shingles(t, ngram) for t in texts]
    digests = [_digest(x) for x in sets]
    sk = [sketch(x) for x in sets]
    sks = np.concatenate(sk or [np.zeros(0, np.int64)])
    sk_at = np.concatenate([[0], np.cumsum([len(x) for x in sk])])
    return [pa.array([len(x) for x in sets], pa.int64()), pa.array([h for h, _ in digests], pa.int64()), pa.array([l for _, l in digests], pa.int64()),
            pa.ListArray.from_arrays(pa.array(sk_at, pa.int32()), pa.array(sks, pa.int64()))]


def _signed(docs: DataFrame, classes: DataFrame, ngram: int, num: int, den: int) -> DataFrame:
    """doc_id, sig of every class, of its representative at least.

    Signatures are many times the size of all else here, so they are made from the texts where they are dealt out and
    stored nowhere. The COPIED most frequent classes go to every task, which then signs only for their representatives;
    copies of rarer classes sign too and are left out where signatures have met.
    """
    most = classes.where("times > 1").orderBy(F.desc("times"), "hi", "lo").limit(COPIED).select("hi", "lo", "rep").toArrow()  # COPIED rows at most
    shared = docs.sparkSession.sparkContext.broadcast([most[c].to_numpy() for c in ("hi", "lo", "rep")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hi, lo, reps = (c.tolist() for c in shared.value)
        rep = dict(zip(zip(hi, lo, strict=True), reps, strict=True))
        for b in (b.slice(i, SIGN) for b in batches for i in range(0, b.num_rows, SIGN)):
            ids, sigs = [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = shingles(t, ngram)
                if len(x) and rep.get(_digest(x), d) == d:
                    sigs.append(signatures(x, num, den))
                    ids.append(np.full(len(sigs[-1]), d, np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(sigs).view(np.int64))], names=["doc_id", "sig"])

    return docs.where("doc_id is not null").select("doc_id", text_or_empty().cast("binary").alias("t")).mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("sig", T.LongType(), False)]))


def _sets_of(docs: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """doc_id, set of the documents in ``wanted`` (doc_id, distinct), and of a few others by chance.

    A bitmap, filled in Spark, lets tasks skip the other texts before they are shingled or shuffled. It has WANTED_BITS
    bits or more for each wanted document; above WANTED documents a join takes its place.
    """
    n = wanted.count()
    shared, bits = None, 1 << 16
    if n <= WANTED:
        while bits < WANTED_BITS * n:
            bits *= 2
        bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
        words = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32768).alias("w")).agg(
            F.expr("bitmap_construct_agg(bit % 32768)").alias("m")).collect()  # 64 MB at most
        bitmap = bytearray(bits // 8)
        for r in words:
            bitmap[r["w"] * 4096 : (r["w"] + 1) * 4096] = bytes(r["m"])
        shared = docs.sparkSession.sparkContext.broadcast(bytes(bitmap))
    else:
        docs = docs.join(wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little") if shared else None
        for b in batches:
            if have is not None:
                b = b.take(pa.array(np.flatnonzero(have[b.column(1).to_numpy()])))
            sets = [np.sort(shingles(t, ngram).view(np.int64)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "set"])

    src = docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("bit"), text_or_empty().cast("binary").alias("t"))
    return src.mapInArrow(run, "doc_id bigint, set array<bigint>")


def _distance_ok(a: str, b: str, na: str, nb: str, num: int, den: int):
    """A lower bound of the difference allows the similarity."""
    width = F.least(F.size(a), F.size(b))
    fold = lambda c, i: F.aggregate(F.sequence(i, F.size(c) - 1, width), F.lit(0).cast("long"), lambda v, j: v.bitwiseXOR(F.col(c)[j]))
    diff = F.aggregate(F.sequence(F.lit(0), width - 1), F.lit(0), lambda v, i: v + F.bit_count(fold(a, i).bitwiseXOR(fold(b, i))))
    sizes = num * F.greatest(na, nb) <= den * F.least(na, nb)
    return F.when(sizes, (den + num) * diff <= (den - num) * (F.col(na) + F.col(nb))).otherwise(False)


def _verify(docs: DataFrame, pairs: DataFrame, ngram: int, num: int, den: int) -> DataFrame:
    """Those of the stored, distinct ``pairs`` (a, b) whose sets have den * intersection >= num * union.

    Only the documents of these pairs are shingled again, and only their sets are moved. The partners of an ``a`` are dealt
    out in blocks, and its set goes to each block once, not to each pair.
    """
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")
    sets = stored(_sets_of(docs, ends, ngram).dropDuplicates(["doc_id", "set"]), "shingles")
    blocks = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    centre = blocks.join(sets.withColumnRenamed("doc_id", "a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("b"), "set")
    partner = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    partner = partner.join(sets.withColumnRenamed("doc_id", "b"), "b").select("a", "block", "b", "set")
    dealt = centre.unionByName(partner).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(lambda batches: _check(batches, num, den), "a bigint, b bigint").distinct()


def _check(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs that hold; the rows of a block come with its centre's sets (more if a doc_id repeats) before its partners'."""
    key, centres = None, []
    for batch in batches:
        a, block, b = (batch.column(c).to_pylist() for c in range(3))
        flat, at = batch.column(3).flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(3)).to_numpy())])
        out = []
        for i in range(len(a)):
            x = flat[at[i] : at[i + 1]]
            if (a[i], block[i]) != key:
                key, centres = (a[i], block[i]), []
            if b[i] is None:
                centres.append(x.copy())
                continue
            for c in centres:
                if len(c) and len(x):
                    n = int((c[np.minimum(np.searchsorted(c, x), len(c) - 1)] == x).sum())
                    if den * n >= num * (len(c) + len(x) - n):
                        out.append((a[i], b[i]))
                        break
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([q for _, q in out], pa.int64())], names=["a", "b"])


def _cross(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of members of a group that lie in different components and pass the lower bound.

    ``members``: sig, total (members of the group), doc_id, n, sk, comp. A block is a hash bucket of a group's doc_ids,
    BLOCK members large on average; blocks are then paired, so no task ever holds a group.
    """
    m = members.withColumn("blocks", F.ceil(F.col("total") / BLOCK).cast("int"))
    m = m.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    with_pair = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = with_pair.select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "n", "sk", "comp")

    dealt = keyed.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return dealt.mapInArrow(lambda batches: _compare(batches, num, den), "a bigint, b bigint").distinct()


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one (sig, i, j); rows come in that order, and a batch's last group waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*rest, b]).combine_chunks()
        key = np.stack([t.column(c).to_numpy() for c in ("sig", "i", "j")])
        edges = 1 + np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0))
        last = int(edges[-1]) if len(edges) else 0
        rest = t.slice(last).to_batches()
        if last:
            yield _near(t.slice(0, last), edges, num, den)
    if rest:
        yield _near(t := pa.Table.from_batches(rest), np.array([t.num_rows]), num, den)


def _near(t: pa.Table, ends: np.ndarray, num: int, den: int) -> pa.RecordBatch:
    """Distinct pairs (a, b) within the groups of ``t`` that end at ``ends`` and pass the lower bound."""
    ids, n, comp, block, i, j = (t.column(c).to_numpy() for c in ("doc_id", "n", "comp", "block", "i", "j"))
    bits = t.column("sk").combine_chunks()
    words, width = bits.flatten().to_numpy(), pc.list_value_length(bits).to_numpy()
    first = np.cumsum(width) - width
    row = np.arange(len(ids))
    partners = np.repeat(ends, np.diff(ends, prepend=0)) - row - 1  # of a row: those after it in its group
    upto = np.cumsum(partners)
    found = [np.zeros((0, 2), np.int64)]

    def maps(at: np.ndarray, wide: int, narrow: int) -> np.ndarray:
        return _folded(words[first[at][:, None] + np.arange(wide)], narrow)

    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        some = row[at:stop]
        left = np.repeat(some, partners[some])
        right = 1 + left + np.arange(len(left)) - np.repeat(upto[some] - partners[some] - (upto[at - 1] if at else 0), partners[some])
        at = stop
        ok = (comp[left] != comp[right]) & (num * np.maximum(n[left], n[right]) <= den * np.minimum(n[left], n[right]))
        ok &= (i[left] == j[left]) | (block[left] != block[right])
        left, right = left[ok], right[ok]
        # pairs of the same two widths together; a wider bitmap is folded to the other's width
        kinds, kind = np.unique(np.stack([width[left], width[right]]), axis=1, return_inverse=True)
        for k, (x, y) in enumerate(kinds.T.tolist()):
            mine = np.flatnonzero(kind.ravel() == k)
            w = min(x, y)
            for part in np.array_split(mine, 1 + len(mine) * max(x, y) // WORDS):
                u, v = left[part], right[part]
                diff = np.bitwise_count(maps(u, x, w) ^ maps(v, y, w)).sum(1, dtype=np.int64)
                near = (den + num) * diff <= (den - num) * (n[u] + n[v])
                found.append(np.sort(np.stack([ids[u[near]], ids[v[near]]], 1), 1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def similar_components(docs: DataFrame, ngram: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``; component_id is the least doc_id reachable by links.

    Two documents link when den * intersection >= num * union of their shingle sets. Null and empty texts have no
    shingles and are linked with nothing. Rows with a null doc_id get a null component_id and link nothing. Rows that
    repeat a doc_id give a row each and, being one document, share a component. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prep = stored(per_text(base, lambda t: _prepare(t, ngram), "n_shingles bigint, hi bigint, lo bigint, sk array<bigint>", ["doc_id"]), "sets")
    usable = prep.where("doc_id is not null and n_shingles > 0")
    classes = stored(usable.groupBy("hi", "lo", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("times")), "classes")
    member = usable.select("doc_id", "hi", "lo", "n_shingles").join(classes, ["hi", "lo", "n_shingles"]).select("doc_id", "rep")

    # Dealt out once: the grouping and the join read the same shuffle. That needs the same plan on both sides, so no
    # column here is nullable and the representatives are joined last; a semi join would be pushed below the shuffle.
    sig = _signed(base, classes, ngram, num, den).repartition("sig")
    groups = sig.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sig", "least")
    # the least of a group is a representative, as a copy's representative signs alike
    met = sig.join(groups.hint("shuffle_hash"), "sig").select("sig", "doc_id", "least")
    shared = stored(met.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").select("sig", "doc_id", "least"), "shared")
    facts = usable.join(classes.select(F.col("rep").alias("doc_id"), "hi", "lo"), ["doc_id", "hi", "lo"], "left_semi").select("doc_id", F.col("n_shingles").alias("n"), "sk").dropDuplicates(["doc_id", "n", "sk"])
    facts = stored(facts.join(shared.select("doc_id").distinct(), "doc_id", "left_semi"), "facts")

    # first the stars
    stars = shared.where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct()
    fa, fb = (facts.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("sk").alias(f"s{k}")) for k in "ab")
    stars = stored(stars.join(fa, "a").join(fb, "b").where(_distance_ok("sa", "sb", "na", "nb", num, den)).select("a", "b"), "stars")
    known = base.where("doc_id is not null")
    links = _verify(known, stars, ngram, num, den)

    # then what the stars leave apart. Rows that repeat a doc_id with other texts tie their classes together.
    tied = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    tied = tied.union(member.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).join(usable.select(F.col("doc_id").alias("b")).groupBy("b").count().where("count > 1"), "b").select("a", "b"))
    links = stored(links.union(tied).distinct(), "links")
    roots = stored(components(links), "roots")
    at = shared.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("sig", "doc_id", F.coalesce("root", "doc_id").alias("comp"))
    # A group of two has been compared as a star, and one of several groups with the same members is enough.
    apart = (at.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("total"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                   F.bit_xor(F.xxhash64("doc_id")).alias("h"), F.bit_xor(F.hash("doc_id")).alias("h2"))
             .where("x < y and total > 2").groupBy("total", "lo", "hi", "h", "h2").agg(F.min("sig").alias("sig")).select("sig", "total"))
    members = at.join(apart, "sig").join(facts, "doc_id")
    left = stored(_cross(members, num, den).join(stars, ["a", "b"], "left_anti"), "left")
    if left.take(1):
        roots = stored(components(links.union(_verify(known, left, ngram, num, den)).distinct()), "roots")
    of = member.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("c"))
    of = of.groupBy("doc_id").agg(F.min("c").alias("component_id"))
    return (prep.select("doc_id", "n_shingles").join(of, "doc_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
