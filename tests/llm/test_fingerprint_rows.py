"""Fingerprints of edits against a plain walk over the rows, with repeated and missing ids."""

import hashlib

from pyspark.sql import functions as F

from perron.llm import fingerprint as fp


def plain(spark, data):
    """(doc_id, n_chars, sha of the edit, fingerprints, likenesses) of each row, the rows in order."""
    df = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("t", F.coalesce("text", F.lit(""))).withColumn("h", F.xxhash64("t"))
    rows = [(r["doc_id"], r["t"]) for r in df.orderBy(F.col("doc_id").asc_nulls_first(), "h", "t").collect()]
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        a, b, c = (fp.encode(fp.signature(x.encode())) for x in (t, e, nxt))
        share = lambda x, y: float(x == y) if not x or not y else sum(x[j : j + 4] == y[j : j + 4] for j in range(0, len(x), 4)) / (len(x) // 4)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, share(a, b), share(a, c)))
    return out


def check(spark, data, **kw):
    got = [tuple(r) for r in fp.fingerprint_edits(spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id bigint, text string, part int, h string").repartition(3), **kw).collect()]
    assert sorted(got, key=repr) == sorted(plain(spark, data), key=repr)


def test_rows_with_repeated_and_missing_ids(spark):
    text = lambda k: " ".join(f"w{(k * 7 + j) % 50}" for j in range(5 + k % 40))
    data = [(i, text(i)) for i in range(60)] + [(None, text(k)) for k in range(50)] + [(17, text(100 + k)) for k in range(70)] + [(17, text(100))] * 5
    data += [(61, None), (62, ""), (62, ""), (63, "é😀 ü")]
    for per in (1000, 10, 3):
        check(spark, data, rows_per_range=per)
    check(spark, [(1, "one two three four five six")])
    check(spark, [(None, None), (None, "")])
    assert fp.fingerprint_edits(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_a_hot_id_is_dealt_out(spark):
    data = [(None, f"text {k} of no document at all") for k in range(400)] + [(5, f"text {k} of one") for k in range(400)] + [(i, f"t {i}") for i in range(10, 40)]
    seen = []
    keep, fp._edits = fp._edits, None
    try:
        def counted(batches):
            import pyarrow as pa
            n = sum(b.num_rows for b in batches)
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([0]), *(pa.array([""]) for _ in range(3)), pa.array([0.0]), pa.array([0.0])],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        fp._edits = counted
        seen = [r["doc_id"] for r in fp.fingerprint_edits(spark.createDataFrame(data, "doc_id bigint, text string"), rows_per_range=20).collect()]
    finally:
        fp._edits = keep
    assert max(seen) < 400 and len([n for n in seen if n]) >= 4
