"""Quality rules: word, symbol and repetition counts, and a line labeller.

Lines of a text are labelled content or boilerplate by a linear-chain conditional random field: each line has a few
shape features, neighbouring labels have transition weights, and Viterbi decoding finds the best sequence. A
document is kept when content lines hold at least ``min_share`` of its words. The field is fitted by maximum
likelihood on a bounded sample of labelled documents, whose lines carry their document's label.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import per_text, text_or_empty

SYMBOLS = b"#*$%&|<>"
#: Bound of the training sample: documents per class, lines per document used in fitting, and the runs that these come in.
SAMPLE_DOCS, SAMPLE_LINES, RUNS = 600, 64, 4
FEATURES = ["bias", "symbols", "caps", "digits", "repeated", "same_as_before", "no_stop", "short", "long_word", "punct_run"]


def counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = raw.split()
    n = len(words)
    # code points are the bytes that do not continue a character
    word_chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else []
    dup = len(lines) - len(set(lines))
    grams = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        times, reach = Counter(grams), 0
        for i, g in enumerate(grams):
            if times[g] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return n, word_chars, symbols, dup, repeated


def _cased(line: bytes) -> tuple[int, int]:
    """Upper-case letters and letters that have a case, of any script."""
    if line.isascii():
        m = len(line)
        upper = m - len(line.translate(None, _UPPER))
        return upper, upper + m - len(line.translate(None, _LOWER))
    text = line.decode("utf-8", "replace")
    low, up = text.lower(), text.upper()
    if len(low) != len(text) or len(up) != len(text):  # letters that become two
        upper = sum(map(str.isupper, text))
        return upper, upper + sum(map(str.islower, text))
    upper = sum(map(ne, text, low))
    return upper, upper + sum(map(ne, text, up))


def line_features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, words per line) of the lines that have words."""
    rows, sizes, before = [], [], set()
    for line in raw.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        m = len(line)
        upper, letters = _cased(line)
        sym = m - len(line.translate(None, SYMBOLS + b"!"))
        rows.append((1.0, min(1.0, 2.0 * sym / n), upper / max(1, letters),
                     min(1.0, 4.0 * (m - len(line.translate(None, b"0123456789"))) / m), 1 - len(set(words)) / n,
                     float(line in before), float(line.rstrip()[-1:] not in b".!?:;\"'"), float(n < 3),
                     float(m / n > 14), float(b"!!" in line or b"###" in line or b" | " in line)))
        before.add(line)
        sizes.append(n)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"


def viterbi(unary: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best label sequence for ``unary`` (lines x 2) and ``trans`` (from x to); ties go to label 1, content."""
    n = len(unary)
    if not n:
        return np.zeros(0, np.int8)
    a, b = float(unary[0, 0]), float(unary[0, 1])
    t00, t01, t10, t11 = (float(x) for x in trans.ravel())
    back = []
    for u0, u1 in unary[1:].tolist():
        x0, x1, y0, y1 = a + t00, b + t10, a + t01, b + t11
        back.append((x1 >= x0, y1 >= y0))
        a, b = max(x0, x1) + u0, max(y0, y1) + u1
    out = np.empty(n, np.int8)
    cur = out[n - 1] = b >= a
    for i in range(n - 2, -1, -1):
        cur = out[i] = back[i][int(cur)]
    return out


def fit_crf(docs: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.2, l2: float = 1e-3) -> dict:
    """Weights by gradient ascent on the conditional likelihood; ``docs`` holds (line features, label of all lines)."""
    k = len(FEATURES)
    docs = [(x, y) for x, y in docs if len(x)]
    if len({y for _, y in docs}) < 2:  # nothing to tell apart: all is content
        return {"w": np.zeros((k, 2)), "trans": np.zeros((2, 2))}
    size = max(len(x) for x, _ in docs)
    X = np.zeros((len(docs), size, k))
    mask = np.zeros((len(docs), size), bool)
    Y = np.array([y for _, y in docs])
    for i, (x, _) in enumerate(docs):
        X[i, : len(x)], mask[i, : len(x)] = x, True
    # each class weighs the same, and each document by its number of lines
    weight = np.where(Y == 1, 0.5 / max(1, mask[Y == 1].sum()), 0.5 / max(1, mask[Y == 0].sum()))
    w, t = np.zeros((k, 2)), np.zeros((2, 2))
    gold = np.eye(2)[Y]
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    lse = np.logaddexp.reduce
    for step in range(1, steps + 1):
        u = X @ w
        fwd, bwd = np.zeros((len(docs), size, 2)), np.zeros((len(docs), size, 2))
        fwd[:, 0] = u[:, 0]
        for i in range(1, size):
            nxt = lse(fwd[:, i - 1, :, None] + t, axis=1) + u[:, i]
            fwd[:, i] = np.where(mask[:, i, None], nxt, fwd[:, i - 1])
        for i in range(size - 2, -1, -1):
            nxt = lse(t + (u[:, i + 1] + bwd[:, i + 1])[:, None, :], axis=2)
            bwd[:, i] = np.where(mask[:, i + 1, None], nxt, 0)
        z = lse(fwd[:, -1], axis=1)
        p = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
        pair = np.exp(fwd[:, :-1, :, None] + t + (u + bwd)[:, 1:, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        gw = np.einsum("dlk,dlc,d->kc", X, gold[:, None, :] * mask[..., None] - p, weight) - l2 * w
        gt = np.einsum("dlab,d->ab", gold[:, None, :, None] * gold[:, None, None, :] * mask[:, 1:, None, None] - pair, weight) - l2 * t
        for g, m, v, x in ((gw, mw, vw, w), (gt, mt, vt, t)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"w": w, "trans": t}


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Fits the field on at most ``sample_docs`` documents of each class, chosen by a hash of doc_id.

    Of rows that repeat a labelled doc_id the text with the least hash is taken.
    """
    lab = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
    pick = None
    for y in (0, 1):
        part = lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        pick = part if pick is None else pick.union(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").withColumn("th", F.xxhash64(text_or_empty()))
    rows = per_text(rows, _sample_features, "x array<double>", ["doc_id", "y", "th"]).groupBy("doc_id", "y").agg(F.min(F.struct("th", "x")).alias("least"))
    got = sorted(rows.select("doc_id", "y", "least.x").collect(), key=lambda r: r["doc_id"])  # bounded: sample_docs, SAMPLE_LINES lines each
    return fit_crf([(np.array(r["x"]).reshape(-1, len(FEATURES)), r["y"]) for r in got])


def _sample_features(texts: list[bytes]) -> list[pa.Array]:
    return [pa.array([_some(line_features(t)[0], t).ravel() for t in texts], pa.list_(pa.float64()))]


def _some(x: np.ndarray, raw: bytes) -> np.ndarray:
    """SAMPLE_LINES lines at most: RUNS contiguous runs, one of each equal stretch of the text, placed by its hash."""
    if len(x) <= SAMPLE_LINES:
        return x
    n, edges = SAMPLE_LINES // RUNS, np.linspace(0, len(x), RUNS + 1).astype(int)
    rng = np.random.Generator(np.random.PCG64(zlib.crc32(raw)))
    starts = [int(rng.integers(a, max(a, b - n) + 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return np.concatenate([x[s : s + n] for s in starts])


def rules(docs: DataFrame, model: dict, min_words: int = 50, max_repeat: float = 0.5, min_share: float = 0.5) -> DataFrame:
    """doc_id, the counts, content_share, base_failed and kept: one row for each row of ``docs``.

    Null text counts as empty: no words, failed, not kept. A text without words has content_share 0. Null doc_id stays
    null, repeated rows give a row each, other columns are ignored.
    """
    w, trans = model["w"], model["trans"]

    def run(texts: list[bytes]) -> list[pa.Array]:
        base = np.array([counts(t) for t in texts], np.int64).reshape(-1, 5)
        feats = [line_features(t) for t in texts]
        unary = np.concatenate([x for x, _ in feats] or [np.zeros((0, len(FEATURES)))]) @ w
        share, at = np.zeros(len(texts)), 0
        for i, (x, sizes) in enumerate(feats):
            labels = viterbi(unary[at : at + len(x)], trans)
            at += len(x)
            share[i] = (sizes * labels).sum() / sizes.sum() if len(x) else 0.0
        failed = (base[:, 0] < min_words) | (base[:, 4] > max_repeat * base[:, 0])
        return [*(pa.array(base[:, i]) for i in range(5)), pa.array(failed), pa.array(~failed & (share >= min_share)), pa.array(share)]

    return per_text(docs, run, "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, content_share double", ["doc_id"])
