"""Signatures of unrelated sets rarely meet, and similar sets always do."""

from collections import Counter

import numpy as np
import pytest

from perron.llm import jaccard
from tests.llm import brute


def met(sets, num, den):
    """Pairs of sets that share a signature."""
    by = Counter()
    for x in sets:
        by.update(set(jaccard.signatures(x, num, den).tolist()))
    return sum(n * (n - 1) // 2 for n in by.values())


def fresh(rng, n):
    return np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100)])
def test_unrelated_sets_do_not_meet(num, den):
    rng = np.random.default_rng(1)
    for low, high in ((1, 2), (5, 12), (50, 100), (100, 300)):
        sets = [fresh(rng, int(rng.integers(low, high))) for _ in range(800)]
        # large sets at low similarities may be thin in the same cell, see _deals
        most = 0.002 * len(sets) ** 2 / 2 if (num, low) == (80, 100) else 0.005 * len(sets)
        assert met(sets, num, den) <= most, low


def test_unrelated_texts_of_one_word(spark):
    texts = [(i, f"word{i}") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    classes = spark.createDataFrame([], "hi bigint, lo bigint, times bigint, rep bigint")
    for share in (80, 90):
        assert jaccard._signed(docs, classes, 5, share, 100).count() == 0  # equal texts are one class; no others can be alike


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100)])
def test_similar_sets_meet(num, den):
    rng = np.random.default_rng(2)
    for n in (2, 4, 5, 9, 10, 19, 20, 40, 150, 400):
        for _ in range(60):
            x = fresh(rng, n)
            y = x.copy()
            while True:
                z = np.unique(np.concatenate([np.delete(y, rng.integers(0, len(y), int(rng.integers(0, 2)))), fresh(rng, int(rng.integers(0, 2)))]))
                i = len(np.intersect1d(x, z))
                if den * i < num * (len(x) + len(z) - i):
                    break
                y = z
                if rng.random() < 0.01:
                    break
            if len(x) == len(y) and (x == y).all():
                continue
            assert set(jaccard.signatures(x, num, den).tolist()) & set(jaccard.signatures(y, num, den).tolist()), (n, len(x), len(y))


def test_links_of_small_and_hub_groups(spark, monkeypatch):
    """Components as by brute force with one hub that has more partners than a block holds, tiny texts and repeated ids."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(base[:40] + [f"x{i}"] + base[41:])) for i in range(40)] + [(100, " ".join(base))]
    texts += [(200 + i, w) for i, w in enumerate(["a", "b", "a b", "a b", "b a", "a b c", "a b c d", "", None])]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == brute.jaccard_components(texts)
    monkeypatch.setattr(jaccard, "WANTED", 3)  # the join in place of the bitmap
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == brute.jaccard_components(texts)
