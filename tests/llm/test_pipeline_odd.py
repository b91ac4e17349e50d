"""The pipeline's stages on nulls, empty texts, repeats, an empty table and columns named like their own."""

import corpus_pipeline as CP

PASSAGE = "\n".join(" ".join(f"shared{k}x{j}" for j in range(15)) for k in range(5))
ROWS = [(1, None), (2, ""), (3, "  \n\t"), (4, PASSAGE + "\nown words"), (5, "other\n" + PASSAGE), (6, PASSAGE), (7, " ".join(f"w{i}" for i in range(200))),
        (8, " ".join(f"w{i}" for i in range(199)) + " end"), (9, "password=hunter2hunter2 here"), (9, "password=hunter2hunter2 here"), (None, "no id AKIA" + "Q7" * 8), (None, None)]
CLASH = "score__ int, n_deleted string, h__ int, key__ int, spans__ string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "a", 2, 3, "b") for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars int, " + CLASH)


def after(df):
    assert set(CLASH.replace(" int", "").replace(" string", "").split(", ")) <= set(df.columns)
    out = df.collect()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) and (r["score__"], r["n_deleted"], r["h__"], r["spans__"]) == (1, "a", 2, "b") for r in out)
    return sorted(((r["doc_id"], r["text"]) for r in out), key=repr)


def test_stages_on_odd_rows(spark):
    docs = table(spark, ROWS)
    got = after(CP.dedup_lines(spark, docs, ""))
    # the passage stays where it comes first; a document that it filled goes, an empty one does not
    assert got == sorted([(5, "other") if i == 5 else (i, t) for i, t in ROWS if i != 6], key=repr)
    got = after(CP.near_duplicates(spark, docs, ""))
    assert got == sorted([(i, t) for i, t in ROWS if i not in (5, 6, 8)], key=repr)
    got = after(CP.mask_secrets(spark, docs, ""))
    assert [(i, t) for i, t in got if i == 9] == [(9, "[SECRET] here")] * 2 and (None, "no id [SECRET]") in got and len(got) == len(ROWS)
    pieces = CP.pack_sequences(spark, docs, "").collect()
    assert sorted(map(repr, (r["doc_id"] for r in pieces if r["piece"] == 0))) == sorted(repr(i) for i, _ in ROWS)
    assert {r["length"] for r in pieces if r["doc_id"] in (1, 2)} == {1}


def test_stages_on_an_empty_table(spark):
    docs = table(spark, ROWS).limit(0)
    for stage in (CP.dedup_lines, CP.near_duplicates, CP.mask_secrets):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0
    assert CP.pack_sequences(spark, docs, "").count() == 0


def test_classifier_stage_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(7, 1, 0), (9, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = CP.quality_classifier(spark, table(spark, ROWS), str(tmp_path))
    assert out.columns == table(spark, ROWS).columns and {r["text"] for r in out.collect()} <= {t for _, t in ROWS}
    assert CP.quality_classifier(spark, table(spark, ROWS).limit(0), str(tmp_path)).count() == 0
