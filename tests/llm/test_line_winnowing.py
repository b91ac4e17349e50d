"""Line dedup: minima choose what is compared, and what is deleted equals all-pairs comparison."""

import random

from pyspark.sql import functions as F

from perron.llm import line_dedup
from tests.llm import brute


def lines_of(spark, texts):
    """The lines with their windows as repeated_lines() makes them, caught on their way to the extents."""
    caught = []
    keep, line_dedup.extended = line_dedup.extended, lambda lines: caught.append(lines) or keep(lines)
    try:
        dead = line_dedup.repeated_lines(spark.createDataFrame([(i, i, t) for i, t in texts], "doc bigint, key bigint, text string")).collect()
    finally:
        line_dedup.extended = keep
    return caught[0], dead


def unique(n, tag):
    return [" ".join(f"{tag}{k}w{j}" for j in range(10)) for k in range(n)]


def test_minima_choose(spark):
    cand = spark.range(200).select(F.concat_ws(" ", *[F.concat(F.lit(f"common{j}x"), "id") for j in range(10)]).alias("line"))
    cand = [r["line"] for r in cand.orderBy(F.xxhash64("line")).collect()]
    low, high = cand[0], cand[-1]
    for common, chosen in ((high, False), (low, True)):
        texts = [(i, "\n".join([*unique(6, f"a{i}"), common, *unique(6, f"b{i}")])) for i in range(8)]
        lines, dead = lines_of(spark, texts)
        assert dead == []
        # the line occurs in all texts; only where it is a minimum does it make its windows candidates
        shared = line_dedup.shared_fingerprints(lines).count()
        got = line_dedup.extended(lines)
        assert (shared, got.count() > 0) == ((1, True) if chosen else (0, False))
        places = lines.where("anew").count()
        assert places < lines.where("fp is not null").count()  # fewer fingerprints than windows
        if chosen:  # extents lie around the chosen line only, not wherever a window starts
            assert {r["start"] for r in got.collect()} == {3, 4, 5, 6, 7}


def test_extents_go_on_to_the_end_of_a_match(spark):
    head, body, tail = unique(3, "h"), unique(6, "s"), unique(3, "t")
    texts = [(1, "\n".join(head + body + tail)), (2, "\n".join(unique(2, "x") + body + tail[:2] + unique(2, "y"))), (3, "\n".join(unique(2, "z") + head[1:] + body[:4]))]
    want = brute.dedup_lines_all(texts)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == want and got[2] == "\n".join(unique(2, "x") + unique(2, "y")) and got[3] == "\n".join(unique(2, "z"))


def test_random_repeats(spark):
    rng = random.Random(11)
    pool = [" ".join(f"p{k}v{j}" for j in range(rng.choice([1, 3, 8, 12, 30, 60]))) for k in range(60)]
    texts = []
    for i in range(70):
        out = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(pool))
            out += pool[at : at + rng.randrange(1, 12)] if rng.random() < 0.7 else [rng.choice(["", " ", f"own {i} line {rng.random()}", pool[0]])]
        texts.append((i, "\n".join(out)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == brute.dedup_lines_all(texts)


def test_fewer_words(spark):
    texts = [(1, "a b\nc d e\nf"), (2, "x\na b\nc d e"), (3, "c d e\nf\na b"), (4, None), (5, ""), (5, "a b\nc d e")]
    got = line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string"), 4)
    want = brute.dedup_lines_all([(1, texts[0][1]), (2, texts[1][1]), (3, texts[2][1]), (5, "a b\nc d e")], 4)
    assert {r["doc_id"]: r["text"] for r in got.where("text is not null and text <> ''").collect()} == {k: v for k, v in want.items() if v}
