"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms are word shapes, pairs of shapes, marks of repetition and hashed words, weighted by log counts and inverse
document frequency over all documents. A truncated singular value decomposition of a bounded labelled sample gives
the projection. The sample's vectors and labels are broadcast (``sample`` x ``dims`` numbers at most); each batch of
documents is multiplied with them in blocks, so every document's cosine with every labelled vector is exact, and
the labels of the nearest vote, weighted by similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.base import small_batches, text_or_empty

#: Size of the hashed term space: shapes and their pairs below SHAPES, words above.
SHAPES, WORDS = 4096, 4096
SPACE = SHAPES + WORDS
#: Bounds of the fitted model: labelled documents per class, and latent dimensions.
SAMPLE, DIMS, NEIGHBOURS = 1000, 48, 15
#: Documents whose vectors of SPACE numbers are held at once.
BLOCK = 128
#: A worker forgets its table of known words when it has this many, and at the end of a task: it outlives the stage, and
#: the next stages' memory is beside it. Values do not change.
CACHED_WORDS = 200_000
_LETTERS = bytes(b if b < 33 else ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_known: list[dict[bytes, int]] = [{}, {}]  # two generations


def forget() -> None:
    """Empties this worker's table of known words."""
    _known[:] = [{}, {}]


def _word(w: bytes) -> int:
    """A word's shape (letters as a or A, digits as 0, runs as one) and its place among the words, as one number."""
    shape = _RUN.sub(rb"\1", w[:64].translate(_LETTERS))[:8]
    return (1 + zlib.crc32(shape) % (SHAPES - 1)) * WORDS + zlib.crc32(w.lower()) % WORDS


def terms(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term numbers and log counts of a text; an empty text has one term of its own."""
    words = raw.split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1, np.float32)
    if len(_known[0]) > CACHED_WORDS:
        _known[:] = [{}, _known[0]]
    young, old = _known
    times = Counter(words)
    for w in times:
        if w not in young:
            young[w] = old[w] if w in old else _word(w)
    n, m = len(words), len(times)
    code = np.fromiter(map(young.__getitem__, times), np.int64, m)
    place = dict(zip(times, range(m), strict=True))
    ids = np.fromiter(map(place.__getitem__, words), np.int64, n)
    s = (code // WORDS)[ids]
    pairs = 1 + (s[:-1] * 2654435761 + s[1:] * 40503) % (SHAPES - 1)
    idx, count = [pairs, s, SHAPES + code % WORDS], [np.ones(len(pairs) + n), np.fromiter(times.values(), float, m)]
    # repetition: words that equal the one before, and three-word windows beyond the distinct ones
    again = int((ids[1:] == ids[:-1]).sum())
    grams = n - 2 - len(np.unique((ids[:-2] * m + ids[1:-1]) * m + ids[2:])) if n > 2 else 0
    for name, v in ((b"\1again", again), (b"\1grams", grams)):
        levels = 1 + int(8 * v / n) if v else 0  # a higher share has more terms
        idx.append(np.array([1 + zlib.crc32(name + bytes([k])) % (SHAPES - 1) for k in range(levels)], np.int64))
        count.append(np.full(levels, float(v)))
    at, inv = np.unique(np.concatenate(idx), return_inverse=True)
    v = 1 + np.log(np.bincount(inv, np.concatenate(count)))
    # shapes tell style, single words hardly do: words weigh less
    return at, np.where(at < SHAPES, v, 0.3 * v).astype(np.float32)


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows of ``docs`` each term occurs, and the number of rows. Each task sends one row for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(SPACE + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                df[terms(t)[0]] += 1
            df[SPACE] += b.num_rows
        forget()
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "n"])

    rows = (small_batches(docs).select(text_or_empty().cast("binary").alias("t")).mapInArrow(run, "term int, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())  # at most SPACE + 1 rows
    df = np.zeros(SPACE + 1)
    for r in rows:
        df[r["term"]] = r["n"]
    return df[:SPACE], int(df[SPACE])


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of weighted terms, rows x SPACE."""
    out = np.zeros((len(texts), SPACE), np.float32)
    for i, t in enumerate(texts):
        at, v = terms(t)
        out[i, at] = v
    out *= idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dims: int = DIMS) -> dict:
    """The model: idf, projection, and the unit vectors and labels of the sample.

    Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1. The sample has at most ``sample``
    documents of each class, chosen by a hash of doc_id (of rows that repeat one, the text with the least hash); document frequencies cover all rows of ``docs``. Without labels
    of both classes the model is None and every document scores 0.5.
    """
    lab = (labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
           .where("crc32(cast(cast(doc_id as string) as binary)) % 3 != 1").groupBy("doc_id").agg(F.min("y").alias("y")))
    pick = None
    for y in (0, 1):
        part = lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        pick = part if pick is None else pick.union(part)
    df, n = document_frequency(docs)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [terms(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array([i.astype(np.int32) for i, _ in x], pa.list_(pa.int32())), pa.array([v for _, v in x], pa.list_(pa.float32()))], names=["doc_id", "y", "th", "i", "v"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t")).join(F.broadcast(pick), "doc_id").select("doc_id", "y", "t", F.xxhash64("t").alias("th"))
    rows = src.mapInArrow(run, "doc_id bigint, y int, th bigint, i array<int>, v array<float>")
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct("th", "i", "v")).alias("least")).select("doc_id", "y", "least.i", "least.v").toArrow()  # bounded by the sample
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    y = rows["y"].to_numpy().astype(np.float32)[order]
    if len(set(y.tolist())) < 2:
        return {"none": True}
    X = np.zeros((len(y), SPACE), np.float32)
    for k, j in enumerate(order):
        X[k, rows["i"][int(j)].values.to_numpy()] = rows["v"][int(j)].values.to_numpy()
    X *= idf
    X /= np.maximum(np.linalg.norm(X, axis=1, keepdims=True), 1e-12)
    # right singular vectors from the small Gram matrix of the sample; the sample's labels play no part
    gram = (X @ X.T).astype(np.float64)
    val, vec = np.linalg.eigh(gram)
    top = np.argsort(val)[::-1][: min(dims, len(y))]
    top = top[val[top] > 1e-9]
    proj = (X.T @ (vec[:, top] / np.sqrt(val[top]))).astype(np.float32)
    Z = X @ proj
    Z /= np.maximum(np.linalg.norm(Z, axis=1, keepdims=True), 1e-12)
    return {"idf": idf, "proj": proj, "z": Z, "y": y}


def score_texts(texts: list[bytes], model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores 0 to 1; equal texts score equally. Neighbours beyond the last are cut by similarity, ties by sample order."""
    if "none" in model:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    k = min(neighbours, len(model["y"]))
    for a in range(0, len(texts), BLOCK):
        z = vectors(texts[a : a + BLOCK], model["idf"]) @ model["proj"]
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        sim = np.round(z @ model["z"].T, 5)
        near = _top(sim, k)
        s = np.maximum(np.take_along_axis(sim, near, 1), 0).astype(np.float64) ** 8
        total = s.sum(1)
        out[a : a + len(z)] = np.where(total > 0, (s * model["y"][near]).sum(1) / np.maximum(total, 1e-300), 0.5)
    return np.clip(out, 0, 1)


def _top(sim: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most similar of each row, ties by place, listed by place."""
    near = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1)
    chosen = np.take_along_axis(sim, near, 1)
    last = chosen.min(1, keepdims=True)
    # rows in which the last similarity occurs more often than it was taken
    for i in np.flatnonzero((sim == last).sum(1) > (chosen == last).sum(1)):
        near[i] = np.sort(np.argsort(-sim[i], kind="stable")[:k])
    return near


def score_batches(batches: Iterator[pd.Series], model: dict) -> Iterator[pd.Series]:
    """The scores of a task's texts."""
    for s in batches:
        yield pd.Series(score_texts([x or b"" for x in s.tolist()], model))
    forget()


def score_column(model: dict, col: Column) -> Column:
    """The score of a text column, null as empty."""
    shared = model

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from score_batches(batches, shared)

    return score(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``.

    Null text counts as empty; a null doc_id stays null and is not held out; repeated rows give a row each; columns other
    than doc_id and text are ignored.
    """
    model = fit(docs, labels)
    held = F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"), F.lit(False))
    scored = docs.select("doc_id", held.alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
