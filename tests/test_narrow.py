"""Narrowing names every value that does not fit, and writes nothing silently changed."""

import pytest

from perron.operators import narrow as N

KINDS = {"n": "int", "at": "timestamp", "name": 3}


def test_faults_are_named(spark, tmp_path):
    rows = spark.createDataFrame([(1, "7", "2026-01-01 10:00:00", "abc"), (2, "7.5x", "soon", "abcd"), (3, None, None, None), (4, "99999999999", "", "éé😀")],
                                 "id int, n string, at string, name string")
    good, bad = N.write_narrowed(rows, KINDS, f"{tmp_path}/a", ["id"], quarantine=True)
    assert sorted((r.id, r.n, str(r.at), r["name"]) for r in good.collect()) == [(1, 7, "2026-01-01 10:00:00", "abc"), (3, None, "None", None)]
    assert sorted(tuple(r) for r in bad.collect()) == [(2, "at", "not a timestamp", "soon"), (2, "n", "not a int", "7.5x"), (2, "name", "longer than 3", "abcd"),
                                                       (4, "at", "not a timestamp", ""), (4, "n", "not a int", "99999999999")]
    with pytest.raises(N.NarrowingError, match=r"at: 2 not a timestamp .*; n: 2 not a int \(such as '7.5x'\); name: 1 longer than 3 \(such as 'abcd'\)"):
        N.write_narrowed(rows, KINDS, f"{tmp_path}/b", ["id"])
    good, bad = N.write_narrowed(rows.where("id in (1, 3)"), KINDS, f"{tmp_path}/c", ["id"])
    assert good.count() == 2 and bad.count() == 0 and dict(good.dtypes)["at"] == "timestamp"
    assert N.write_narrowed(rows.limit(0), KINDS, f"{tmp_path}/d", ["id"])[0].count() == 0
