"""Secret scan of texts with thousands of parts, and masking against a plain version."""

import random
import time

from perron.llm import secrets


def masked(text, spans, mark="[SECRET]"):
    out, at = "", 0
    for s, e in spans:
        if s >= at:
            out += text[at:s] + mark
        at = max(at, e)
    return out + text[at:]


def plain_find(text):
    base = [(k, s, e) for k, s, e in secrets.find(text) if k in ("assign", "access", "hex")]
    weak = [(k, m.start(), m.end()) for k, p in (("key", secrets.KEY), ("endpoint", secrets.ENDPOINT), ("identifier", secrets.IDENTIFIER)) for m in p.finditer(text)
            if not any(s < m.end() and m.start() < e for _, s, e in base)]
    return sorted(base + weak, key=lambda x: (x[1], secrets.ORDER[x[0]]))


def text_of(rng, n):
    key = "".join(rng.choice("abcXYZ0189+/") for _ in range(37)) + "aZ9"
    parts = ["password=hunter2hunter2", "AKIA" + "Q7" * 8, "deadbeef" * 5, key, "client_id=some.user", "https://api.host.example/x", "é😀 prose", "token: " + key, "secret_id"]
    return " ".join(rng.choice(parts) for _ in range(n))


def test_overlaps_as_by_comparing_all():
    rng = random.Random(5)
    for n in (0, 1, 5, 40, 300):
        t = text_of(rng, n)
        assert secrets.find(t) == plain_find(t)


def test_many_parts_take_linear_time():
    rng, took = random.Random(6), []
    for n in (4_000, 40_000):
        t = text_of(rng, n)
        start = time.time()
        secrets.find(t)
        took.append(time.time() - start)
    assert took[1] < 30 * took[0] + 0.5


def test_masking(spark):
    rng = random.Random(7)
    data = [(i, text_of(rng, n)) for i, n in enumerate((0, 3, 60, 3_000))] + [(9, None), (10, ""), (11, "no part"), (12, "password=hunter2hunter2")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in data], "doc_id bigint, text string, n_chars int, raw__ string")
    spans = {r["doc_id"]: [(x["start"], x["end"]) for x in r["spans"]] for r in secrets.scan(docs).collect()}
    got = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    for i, t in data:
        assert got[i]["text"] == (None if t is None else masked(t, spans[i])) and got[i]["raw__"] == "x"
    assert got[12]["text"] == "[SECRET]" and got[12]["n_chars"] == 8
