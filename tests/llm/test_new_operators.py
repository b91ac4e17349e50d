"""Operators 11 to 13 against plain versions, and with nulls, ties, repeats, long texts, empty tables and clashing names."""

import duckdb
import numpy as np
import pytest

from perron.llm import embedding_forest, merkle, ranks, trie
from perron.llm.oracle import SQL
from perron.llm.queries import QUERIES
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_sql(name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(SQL[name])
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name,table", [("op4_jaccard_join", "documents"), ("op5_line_dedup", "documents"), ("op11_embedding_dedup", "embeddings"), ("op12_merkle_manifest", "documents"), ("op13_prefix_trie", "conversations")])
def test_sql(spark, name, table):
    df = QUERIES[name](spark, SF)
    cols, want = by_sql(name, table)
    assert sorted(rows(df.select(*cols)), key=repr) == sorted(want, key=repr)


# --- ranks

@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_ranked(spark, ranges):
    data = [("a" if i % 3 else None, i * 7 % 50) for i in range(300)] + [("b", None), ("b", 5)]
    out = rows(ranks.ranked(spark.createDataFrame(data, "g string, x int"), ["g"], ["x"], "k", "n", ranges).select("g", "x", "k", "n", "part__"))
    for g in ("a", None, "b"):
        mine = sorted((k, x) for h, x, k, _, _ in out if h == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and {n for h, _, _, n, _ in out if h == g} == {len(mine)}
        assert [x for _, x in mine] == sorted((x for h, x in data if h == g), key=lambda x: (x is not None, x))
    assert rows(ranks.ranked(spark.createDataFrame([], "g string, x int"), ["g"], ["x"])) == []
    # rows that are equal in all are split as well
    many = ranks.ranked(spark.createDataFrame([("a", 1)] * 200, "g string, x int"), ["g"], ["x"], "k", "n", 8)
    assert sorted(r["k"] for r in many.collect()) == list(range(200)) and many.select("part__").distinct().count() > 3


# --- op11

def planted(seed, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n, 24))
    near = centres[: n // 2] + rng.uniform(0.1, 0.6, (n // 2, 1)) * rng.standard_normal((n // 2, 24))
    hot = centres[0] + 0.15 * rng.standard_normal((150, 24))
    wide = centres[1] + 0.33 * rng.standard_normal((60, 24))
    x = np.concatenate([centres, near, hot, wide, centres[:9]]).astype(np.float32)
    return [(int(i), [float(y) for y in v]) for i, v in enumerate(rng.permutation(x))]


ODD = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [1.0, None] + [0.0] * 22), (9005, [float("nan")] + [1.0] * 23), (9006, [float("inf")] + [1.0] * 23),
       (None, [1.0] * 24), (9007, [1.0] * 3), (9008, [2.0, 2.0, 2.0]), (9009, [1.0] * 24), (9009, [1.0] * 24), (9009, [-1.0] * 24), (9010, [-2.0] * 24), (9011, [1e30] * 24), (9012, [-0.0] * 23 + [1.0])]


@pytest.mark.parametrize("settings", [{}, {"leaf": 16, "sample": 96, "least": 4, "block": 32, "dense": 4}, {"leaf": 24, "block": 16, "dense": 10**9}])
def test_embeddings(spark, settings):
    data = planted(1) + ODD
    df = spark.createDataFrame([(i, v, i, 1) for i, v in data], "vec_id bigint, embedding array<float>, cid bigint, leaf int")
    out = rows(embedding_forest.near_duplicates(df.repartition(5), embedding_forest.Forest(**settings)))
    want = plain.embedding_links([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in data])
    assert len(out) == len(want)
    links = sum(x[1] for x in want)
    assert sum(x[1] for x in out) >= 0.99 * links  # recall
    most = {}
    for i, n, *_ in want:
        most.setdefault(i, []).append(n)
    assert all(n <= max(most[i]) for i, n, *_ in out)  # no pair below the threshold
    if not settings:
        assert sorted(out, key=repr) == sorted(want, key=repr)


def test_embeddings_small(spark):
    assert rows(embedding_forest.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>"))) == []
    assert rows(embedding_forest.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id int, embedding array<double>"))) == [(1, 0, 1, True)]


def test_embeddings_pairs_stay_in_leaves():
    # a leaf gives numbers, not pairs: no more rows than it has vectors, though all are linked
    x = np.ones((300, 8)) + 0.01 * np.random.default_rng(0).standard_normal((300, 8))
    i, j = embedding_forest._pairs(embedding_forest.units(x), np.zeros(300, int), False, 0.9)
    assert len(i) == 300 * 299 // 2
    assert (embedding_forest._trees_of(i, j, 300) == 0).all()


def test_first_common_leaf():
    leaves = [[1, 5, 9], [2, 5, 9], [1, 9], [9]]
    at, flat = np.cumsum([0] + [len(x) for x in leaves]), np.array(sum(leaves, []))
    i, j = np.array([0, 0, 0, 1, 1, 2]), np.array([1, 2, 3, 2, 3, 3])
    assert embedding_forest._first_here(i, j, 9, at, flat).tolist() == [False, False, True, True, True, True]


# --- op12

DOCS = [(i, ["s1", "s2", "é", None][0 if i % 7 else i % 4], "en" if i % 3 else None, None if i % 5 == 0 else i, ["Text %d" % i, None, "", "Ünïcode " * 3, "UPPER" * 9_000][i % 5]) for i in range(700)]
DOCS += [(None, "s1", None, None, None), (None, "s1", "x", 1, "AAA"), (3, "s1", "en", 3, "Other"), (3, "s1", "en", 3, "Other"), (5000, "lone", "de", 1, "A")]
DOC_SCHEMA = "doc_id bigint, source string, lang string, n_chars int, text string"


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_merkle(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)  # less depth makes more rounds: 700 leaves need three levels
    df = spark.createDataFrame([(*r, "x", 1) for r in DOCS], DOC_SCHEMA + ", leaf string, place int").repartition(6)
    out = rows(merkle.manifest(df))
    assert sorted(out, key=repr) == sorted(plain.merkle(DOCS), key=repr)
    bad = {r[0] for r in out if not r[6]}
    assert 50 in bad or bad  # tampering shows


def test_merkle_small(spark):
    assert rows(merkle.manifest(spark.createDataFrame([], DOC_SCHEMA))) == []
    one = [(1, None, None, None, None)]
    (got,) = rows(merkle.manifest(spark.createDataFrame(one, DOC_SCHEMA)))
    assert [got] == plain.merkle(one) and got[1] == got[2] == got[3] == got[5] and got[4] == plain.sha("")


# --- op13

def talks():
    """Shared first turns, copies, prefixes of each other, ties, nulls and a long conversation."""
    out = []
    for c in range(90):
        n = c * 5 % 11
        out += [(c, t, "user" if t % 2 else "assistant", f"{t} says {c // (10 if t < 3 else 3 if t < 6 else 1)} é") for t in range(n)]
    out += [(500 + c, t, "user", "same") for c in range(12) for t in range(12)]  # copies
    out += [(600 + c, t, "user", "same") for c in range(12) for t in range(9 + c)]  # each a prefix of the next
    out += [(700, None, None, None), (700, None, "a", "x"), (700, 1, "b", "y"), (700, 1, "b", "y"), (700, 1, "a", "z"), (None, 1, "user", "lost")]
    out += [(801, t, "user", f"t{t}") for t in range(300)] + [(800, t, "user", f"t{t}") for t in range(290)]
    out += [(-7, 0, "user", "neg"), (-5, 0, "user", "neg"), (-5, 1, "user", "more")] + [(1000 + c, 0, "u", "gone") for c in range(1, 5)]
    return out


SAID = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("settings", [{}, {"CHUNK": 2, "IDS": 2, "RANGE": 9}, {"CHUNK": 5, "IDS": 3, "RANGE": 3}])
def test_trie(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(trie, k, v)
    data = talks()
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SAID + ", key string, n int").repartition(5)
    got = rows(trie.nodes(df))
    want = plain.trie(data)
    assert len(got) == len(set(got)) and set(got) == want


def test_trie_small(spark):
    for data in ([], [(None, 1, "u", "x")], [(3, 0, "u", "x")], [(0, 0, None, None)], [(1, 0, "u", "x"), (2, 0, "u", "x")], [(4, 0, "u", "x"), (9, 0, "u", "y")],
                 [(0, t, "u", "a") for t in range(12)] + [(1, t, "u", "a") for t in range(12)]):
        got = rows(trie.nodes(spark.createDataFrame(data, SAID)))
        assert len(got) == len(set(got)) and set(got) == plain.trie(data), data


def test_range_minima():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        x = rng.integers(0, 6, n)
        t = trie.sparse_table(x)
        at, d = rng.integers(0, n, 50), rng.integers(0, 8, 50)
        for a, v, f, l in zip(at, d, trie.first_below(t, at, d), trie.last_below(t, at, d), strict=True):
            assert f == next((k for k in range(a, n) if x[k] < v), n)
            assert l == next((k for k in range(a, -1, -1) if x[k] < v), -1)
        lo, hi = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
        assert trie.minimum(t, lo, hi).tolist() == [x[a : b + 1].min() for a, b in zip(lo, hi, strict=True)]
