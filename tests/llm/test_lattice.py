"""The lattice's segmentation against a plain Viterbi over the same pieces."""

from pyspark.sql import functions as F

from perron.llm import sentencepiece_lattice as sl
from perron.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def best(unit, scores, pieces):
    """Ids by trying every last piece for each prefix; of equal scores the longer last piece."""
    cells = [(0.0, [])]
    for e in range(1, len(unit) + 1):
        found = []
        for s in range(max(0, e - pieces.longest), e):
            sub = unit[s:e]
            if sub in scores:
                i, w = scores[sub]
                found.append((cells[s][0] + w, -s, [*cells[s][1], i]))
            elif e - s == 1:
                raw = sub.encode()
                found.append((cells[s][0] + len(raw) * pieces.fallback, -s, [*cells[s][1], *(pieces.bytes[b] for b in raw)]))
        w, _, ids = max(found, key=lambda x: x[:2])
        cells.append((w, ids))
    return cells[-1][1]


def test_segmentation_is_the_best(spark):
    pieces = sl.Pieces(tokenizer_path("piece_bpe_32k.model"))
    scores = {p: (i, w) for p, i, w in pieces.rows}
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts += ["日本語 と mixed ascii\n\n\ttab", "▁marks ▁ here", "a" * 90 + " " + "xyzzy" * 20, "é \x00 😀😀", "  spaces   between "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    vocab = sl.vocabulary(docs)
    seen = {u for t in texts for u in sl.units(t)}
    got = {r["unit"]: r["ids"] for r in sl.encode_units(vocab, pieces).collect()}
    assert got.keys() == seen
    wrong = [u for u in seen if got[u] != best(u, scores, pieces)]
    assert not wrong, wrong[:5]


def test_long_unit(spark):
    unit = "".join(chr(97 + i * 7919 % 26) for i in range(20_000))
    docs = spark.createDataFrame([(1, unit), (2, unit + " tail"), (3, None), (None, "x")], "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in sl.encode(docs, tokenizer_path("piece_bpe_32k.model")).collect()}
    assert all(r["exact"] for r in out.values()) and out[3]["ids"] == []
    assert out[2]["ids"][: out[1]["n_tokens"]] == out[1]["ids"]


def test_most_frequent_units(spark):
    known = spark.createDataFrame([(f"u{i}", 1 << (i % 7), [i]) for i in range(70)] + [("x" * 40, 1 << 20, [1])], "unit string, n bigint, ids array<int>")
    for head in (0, 5, 10, 25, 69, 70, 1000):
        got = sl.most_frequent(known, head)
        n = got.count()
        assert n <= head and n == min(70, head // 10 * 10) and (not n or got.agg(F.min("n")).first()[0] == 1 << (7 - n // 10))


def test_trailing_punctuation_is_a_part(spark):
    """Units that differ in their trailing punctuation share a part, and documents get the ids of whole units, whatever the head holds."""
    pieces = sl.Pieces(tokenizer_path("piece_bpe_32k.model"))
    scores = {p: (i, w) for p, i, w in pieces.rows}
    texts = ["qzorble, qzorble. qzorble!! qzorble", "qzorble%%%\nqzorble\n\n, ... ?!", "  qzorble,  ▁qzorble.\x00a. b\x00 \ue000. 😀, é!", "a. " * 40 + "zwyx###", "", None, ".", " "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id bigint, text string")
    want = {i: [x for u in sl.units(t or "") for x in best(u, scores, pieces)] for i, t in enumerate(texts)}
    for head in (0, 3, 1000):
        out = sl.encode(docs, tokenizer_path("piece_bpe_32k.model"), head=head).collect()
        assert len(out) == len(texts) * 2 and all(r["exact"] and r["ids"] == want[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in out)
        assert all(r["n_units"] == len(sl.units(texts[r["doc_id"]] or "")) for r in out)
    vocab = [r["unit"] for r in sl.vocabulary(docs, pieces.cut).collect()]
    assert len(vocab) == len(set(vocab)) and sorted(u for u in vocab if "qzorble" in u and "\x00" not in u) == ["qzorble", "▁qzorble"]


def test_units_keep_characters_and_order():
    for t in ("a  b\n\nc \n d", "\x00 a\x00b\n\x00", " ", "\n", "▁ \ue000x ▁", "x"):
        assert "".join(sl.units(t)).startswith("▁")
        assert sl.decode([0], ["".join(sl.units(t)).encode()]) == t
        assert all(u == "\n" or ("\n" not in u and "▁" not in u[1:] and " " not in u) for u in sl.units(t))
