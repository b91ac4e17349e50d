"""Verdicts of the fitted operators against plain versions, and their fits on repeated rows."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from perron.llm import chat, classifier, quality_rules
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def best_path(unary, trans):
    """By trying all label sequences; ties go to the one with more content from the end."""
    def score(p):
        return sum(unary[i][c] for i, c in enumerate(p)) + sum(trans[a][b] for a, b in zip(p, p[1:]))
    return max(product((0, 1), repeat=len(unary)), key=lambda p: (round(score(p), 9), p[::-1]))


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    for n in range(1, 11):
        unary, trans = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        assert tuple(quality_rules.viterbi(unary, trans).tolist()) == best_path(unary.tolist(), trans.tolist())
    assert quality_rules.viterbi(np.zeros((3, 2)), np.zeros((2, 2))).tolist() == [1, 1, 1]


def test_kept_is_the_share_of_content_words(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_rules.fit(docs, labels)
    w, trans = model["w"], model["trans"].tolist()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    some = 0
    for r in quality_rules.rules(docs, model).collect():
        x, sizes = quality_rules.line_features(texts[r["doc_id"]].encode())
        assert sizes.tolist() == [len(brute.words(line)) for line in texts[r["doc_id"]].split("\n") if brute.words(line)]
        if 0 < len(x) <= 11:
            some += 1
            labels_ = best_path((x @ w).tolist(), trans)
            share = sum(int(s) for s, c in zip(sizes, labels_, strict=True) if c) / int(sizes.sum())
            assert abs(share - r["content_share"]) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["content_share"] >= 0.5)
    assert some > 20


def test_caps_of_all_scripts():
    for line in ("ÄÖÜ ÉÈ", "äöü", "ABC def 12", "Straße ẞ", "ΑΒγδ", "ДОМ дом", "12 !", "BXYZQ", "İstanbul"):
        upper, letters = quality_rules._cased(line.encode())
        assert (upper, letters) == (sum(c.isupper() for c in line), sum(c.isupper() or c.islower() for c in line)), line


def test_fits_take_one_row_of_a_repeated_id(spark):
    long = "\n".join(f"Line {i} of a long text." for i in range(500))
    docs = spark.createDataFrame([(7, long)] * 300 + [(8, "CLICK HERE $$$ ### NOW")] * 200 + [(7, "another text of the id")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    taken = []
    keep, quality_rules.fit_crf = quality_rules.fit_crf, lambda d: taken.append(d) or keep(d)
    try:
        quality_rules.fit(docs, labels)
    finally:
        quality_rules.fit_crf = keep
    assert [y for _, y in taken[0]] == [1, 0] and len(taken[0][0][0]) <= quality_rules.SAMPLE_LINES
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, quality int")
    data = [(i, f"text {i} {j} " + ("good prose here" if i % 2 else "buy now cheap")) for i in range(12) for j in range(3)]
    one, two = (classifier.fit(spark.createDataFrame(d, "doc_id bigint, text string").repartition(n), labels) for d, n in ((data, 2), (data[::-1], 5)))
    assert np.array_equal(one["z"], two["z"]) and np.array_equal(one["y"], two["y"])


def test_sampled_lines_are_runs_over_the_whole_text():
    x = np.arange(1000.0).reshape(-1, 1)
    got = quality_rules._some(x, b"any text").ravel()
    runs = np.split(got, 1 + np.flatnonzero(np.diff(got) != 1))
    assert len(got) == 64 and len(runs) <= 4 and got[0] < 250 and got[-1] >= 750
    assert len(quality_rules._some(x[:64], b"")) == 64


def test_neighbours_vote(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.fit(docs, labels)
    texts = [r["text"].encode() for r in docs.orderBy("doc_id").limit(60).collect()]
    z = classifier.vectors(texts, model["idf"]) @ model["proj"]
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    sim = np.round(z @ model["z"].T, 5)
    for k, got in enumerate(classifier.score_texts(texts, model)):
        near = sorted(range(len(model["y"])), key=lambda j: (-sim[k, j], j))[: classifier.NEIGHBOURS]
        votes = [max(float(sim[k, j]), 0.0) ** 8 for j in near]
        want = sum(v * float(model["y"][j]) for v, j in zip(votes, near, strict=True)) / sum(votes) if sum(votes) else 0.5
        assert abs(got - want) < 1e-6
    rng = np.random.default_rng(0)
    sim = rng.integers(0, 4, (50, 90)).astype(np.float32)  # many ties
    for row, got in zip(sim, classifier._top(sim, 7), strict=True):
        assert sorted(sorted(range(90), key=lambda j: (-row[j], j))[:7]) == got.tolist()


def test_windows_keep_the_budget(spark):
    """With system turns of any length; only a single turn that is longer by itself goes over."""
    for system in (0, 100, 900, 1400, 1700, 6000, 12000):
        turns = [("system", "s" * system)] + [(("user", "assistant")[i % 2], f"turn {i} " + "word " * (211 * i % 1500)) for i in range(80)] + [("user", "x" * 7000), ("assistant", "y" * 9000)]
        df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
        w = chat.format_windows(df)
        for r in w.select("*", F.octet_length("text").alias("bytes")).collect():
            assert r["n_tokens"] <= 2048 or (r["n_turns"] == 1 and r["n_context"] == 0), (system, r["n_tokens"], r["n_turns"])
            assert r["n_tokens"] >= r["bytes"] / 4  # all that is written counts, what is repeated too
        (got,) = chat.read_back(w).collect()
        want = brute.chat(turns)
        assert {x: got[x] for x in want} == want
    nulls = spark.createDataFrame([(None, 1, "user", "a"), (None, None, None, None), (None, 2, "assistant", "b"), (3, None, "user", "c"), (3, None, "assistant", None)], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r.asDict() for r in chat.read_back(chat.format_windows(nulls)).collect()}
    for k, turns in ((None, [(None, None), ("user", "a"), ("assistant", "b")]), (3, [("assistant", None), ("user", "c")])):
        want = brute.chat(turns)
        assert {x: got[k][x] for x in want} == want
