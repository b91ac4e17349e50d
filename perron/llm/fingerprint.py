"""Document fingerprints by consistent weighted sampling.

A text is the weighted set of its five-word shingles (the weight is the count). For each of K samples every term
draws r and c from Gamma(2, 1) and b from a uniform distribution, all fixed by the term; the term with the smallest
ln c - r * (t - b) - r, where t = floor(ln(weight) / r + b), is the sample together with t. Two texts agree in a
sample with a probability equal to the generalised Jaccard similarity of their weighted sets: sum of minima by sum of
maxima. A Gamma(2, 1) value is a sum of two exponential ones, so a term's draws are sums of entries of two small
tables that two independent parts of its hash select.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import mix64, shuffle_partitions, stored, text_or_empty

SAMPLES, SHINGLE = 64, 5
TABLE_BITS = 12
#: Terms handled at once, which bounds the memory that one long text takes.
CHUNK = 4096


@cache
def _tables(samples: int) -> list[np.ndarray]:
    """For each of two hash parts: exponential draws for r and c and uniform draws, rows x samples."""
    out = []
    for part in range(2):
        rng = np.random.Generator(np.random.PCG64([20240229, part, samples]))
        size = (1 << TABLE_BITS, samples)
        out += [rng.standard_exponential(size).astype(np.float32), rng.standard_exponential(size).astype(np.float32), rng.random(size, np.float32)]
    return out


def terms(raw: bytes, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the shingles; a text of fewer words is one term, one without words has none."""
    words = raw.split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - shingle + 1)
    acc = np.full(n, min(len(h), shingle), np.uint64)
    for k in range(min(len(h), shingle)):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(acc, return_counts=True)


def signature(raw: bytes, samples: int = SAMPLES) -> np.ndarray | None:
    """One 64-bit value per sample; None for a text without words."""
    h, w = terms(raw)
    if not len(h):
        return None
    t1, t2 = _tables(samples)[:3], _tables(samples)[3:]
    best = np.full(samples, np.inf, np.float32)
    out = np.zeros(samples, np.uint64)
    mask = np.uint64((1 << TABLE_BITS) - 1)
    cols = np.arange(samples)
    for a in range(0, len(h), CHUNK):
        hh, ww = h[a : a + CHUNK], w[a : a + CHUNK]
        i, j = (hh & mask).astype(np.intp), ((hh >> np.uint64(32)) & mask).astype(np.intp)
        r = t1[0][i] + t2[0][j]
        c = np.log(t1[1][i] + t2[1][j])
        b = t1[2][i] + t2[2][j]
        b -= np.floor(b)
        t = np.floor(np.log(ww).astype(np.float32)[:, None] / r + b)
        c -= r * (t - b + 1)
        at = c.argmin(0)
        val = c[at, cols]
        less = val < best
        best = np.where(less, val, best)
        out = np.where(less, mix64(hh[at] + t[at, cols].astype(np.int64).astype(np.uint64)), out)
    return out


def encode(sig: np.ndarray | None) -> str:
    """16 bits of each sample as hexadecimal digits; empty without a signature."""
    return "" if sig is None else (sig >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of samples in which two fingerprints agree; two empty texts are alike, an empty and another are not."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def edited(text: str, nxt: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + nxt[:half]


EDITS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame, rows_per_range: int = 1000) -> DataFrame:
    """Fingerprints of all texts and of their edits, with likeness to the edit and to the next document.

    The next document is that of the next doc_id (after the last: the first). Rows are dealt out by ranges of doc_id,
    and a range's first row also goes to the range before, where it only serves as next; so each task reads its rows in
    order and needs no other. Null text counts as empty. Rows with equal doc_id follow each other by a hash of the text, and
    each one's next is the row after it; rows with a null doc_id come first. A doc_id that many rows have (or none) is
    dealt out in buckets of that hash. Other columns are ignored. A single row is its
    own next.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    low = F.lit(-(2**63)).cast("long")
    key = F.coalesce("doc_id", low)
    total, first = d.agg(F.count("*"), F.min(key)).first()
    ranges = max(1, min(int(total // rows_per_range), 8 * shuffle_partitions(spark)))
    # doc_ids that start a range: bounded by the number of ranges
    cuts = d.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], 10_000).alias("c")).first()["c"] or []
    # a doc_id with many rows begins a range, too; it is cut further, by its texts' hashes, into buckets that keep their order
    most, per = 8 * shuffle_partitions(spark), max(rows_per_range, -(-int(total) // ranges))
    hot = d.groupBy(key.alias("key")).agg(F.count("*").alias("rows")).where(F.col("rows") > 4 * per)
    hot = [(r["key"], min(most, -(-r["rows"] // per))) for r in hot.collect()]  # a quarter of the ranges at most
    cuts = sorted({c for c in [*cuts, *(k for k, _ in hot)] if c > first}) if total and (ranges > 1 or hot) else []
    place = F.lit(0)
    if cuts:
        arr = F.array(*[F.lit(c).cast("long") for c in cuts])
        place = F.size(F.filter(arr, lambda c: c <= key)) if len(cuts) <= 64 else _place(arr, key, len(cuts))
    rows = d.withColumn("key", key).withColumn("h", F.xxhash64("text")).withColumn("range", place.cast("int"))
    hot = F.broadcast(spark.createDataFrame(hot, "key bigint, buckets int"))
    rows = rows.join(hot, "key", "left").withColumn("sub", F.coalesce(F.least(F.floor((F.col("h") / 2.0**64 + 0.5) * F.col("buckets")), F.col("buckets") - 1), F.lit(2**31 - 1)).cast("int"))
    # the first row of each part also goes to the part before: a row for each part, numbered in order
    firsts = rows.groupBy("range", "sub").agg(F.min(F.struct("key", "h")).alias("least")).orderBy("range", "sub").collect()
    if not firsts:
        return spark.createDataFrame([], EDITS)
    parts = [(r["range"], r["sub"], i, (i - 1) % len(firsts), r["least"]["key"], r["least"]["h"]) for i, r in enumerate(firsts)]
    parts = F.broadcast(spark.createDataFrame(parts, "range int, sub int, part int, before int, k0 bigint, h0 bigint"))
    rows = rows.join(parts, ["range", "sub"])
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("extra"))
    copy = F.when((F.col("key") == F.col("k0")) & (F.col("h") == F.col("h0")), F.array(own, F.struct(F.col("before").alias("part"), F.lit(1).alias("extra")))).otherwise(F.array(own))
    dealt = (rows.select("doc_id", "key", "h", "text", F.inline(copy))
             .repartition(min(len(firsts), 2 * shuffle_partitions(spark)), "part").sortWithinPartitions("part", "extra", "key", "h", "text"))
    src = dealt.select("part", "extra", "doc_id", F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(_edits, EDITS)


def _place(arr, key, n: int):
    """The number of sorted cuts at or below the key, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(n.bit_length() + 1))

    def halve(a, _):
        mid = ((a["lo"] + a["hi"]) / 2).cast("int")
        up = F.element_at(arr, F.least(mid + 1, F.lit(n))) <= key
        going = a["lo"] < a["hi"]
        return F.struct(F.when(going & up, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(going & ~up, mid).otherwise(a["hi"]).alias("hi"))

    return F.aggregate(steps, start, halve)["lo"]


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the row that waits for its next: (range, doc_id, text, fingerprint)
    rows: list[tuple] = []

    def close(nxt: tuple) -> None:
        _, doc, text, fp = held
        made = edited(text, nxt[2])
        raw = made.encode()
        efp = encode(signature(raw))
        rows.append((doc, len(text), hashlib.sha256(raw).hexdigest(), fp, efp, likeness(fp, efp), likeness(fp, nxt[3])))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        rows.clear()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    for b in batches:
        for rng, extra, doc, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if extra and (held is None or held[0] != rng):
                continue  # more rows with the doc_id that starts the next range: the first has served
            row = (rng, doc, raw.decode("utf-8", "replace"), encode(signature(raw)))
            if held is not None:
                close(row)
            held = None if extra else row
        yield flush()
    yield flush()
