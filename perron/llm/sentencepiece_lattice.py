"""SentencePiece encoding and decoding as a relational lattice.

A text is cut into units before each space and around each line feed, a unit's leading space (and the start of the
text) becoming the mark of a word's start. A unit's trailing punctuation is a part of its own where no piece of the
model holds the two characters at the cut side by side: then no piece spans it, and the best segmentation is that of
the parts one after the other. The distinct parts of the corpus are exploded into substrings of bounded length,
equi-joined with the piece table, and grouped by part again; an edge is one number. Parts are numbered and
hash-partitioned once; explode, join and grouping keep that. The best paths are folded in Arrow batches, one end and
length of all parts of a batch at a time: for each place the best score of a path to it and the piece that ends it.
Characters without a piece fall back to the pieces of their bytes.

Documents then get their ids: the ``head`` most frequent parts (a bounded number of bounded length) go to every task,
and a text becomes its parts' numbers there, the most frequent first; the ids of other parts are joined to the documents
that hold them. Texts are shuffled once, as numbers. No table that grows with the data is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.base import per_text, shuffle_partitions, small_batches, stored, text_or_empty

MARK = "▁"
#: Units sent to every task, and the longest such unit in code points.
HEAD, HEAD_CHARS = 500_000, 32
#: A text's own marks are written with these, reversibly.
_ESC, _ESC_MARK = "\ue000", "\ue001"
#: What may end a unit as a part of its own.
_ENDS = ".,;:!?%#$&|<>()*\"'…"
BATCH = 256
#: Distinct units that a Python worker counts, and that it remembers, at once.
COUNTED, REMEMBERED = 500_000, 400_000


class Pieces:
    """The piece table of a model file: text pieces with scores, and the ids of the 256 byte pieces."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        text = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in text]
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.fallback = min(s for _, _, s in self.rows) - 10.0
        self.raw: list[bytes] = [b""] * n
        for p, i, _ in self.rows:
            self.raw[i] = p.encode()
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])
        # with a space for the mark, as ``spaced`` has it
        self.pairs = {(a + b).replace(MARK, " ") for p, _, _ in self.rows for a, b in zip(p, p[1:], strict=False)}
        # scores add up without rounding, in whatever order
        self.whole = all(w.is_integer() for _, _, w in self.rows)

    def cut(self, unit: str) -> list[str]:
        """The parts of a unit as ``spaced`` has it: its trailing punctuation stands alone where no piece spans the place before it."""
        if unit[-1] not in _ENDS:
            return [unit]
        n = len(unit.rstrip(_ENDS))
        return [unit[:n], unit[n:]] if n and self.whole and unit[n - 1 : n + 1] not in self.pairs else [unit]


def spaced(text: str) -> list[str]:
    """The units of a text with a space for the mark that begins them. An empty text has none."""
    if not text:
        return []
    if _ESC in text or MARK in text:
        text = text.replace(_ESC, _ESC + _ESC).replace(MARK, _ESC + _ESC_MARK)
    if "\0" in text:
        return re.findall(r" [^ \n]*|\n|[^ \n]+", " " + text)
    return list(filter(None, (" " + text).replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))


def units(text: str) -> list[str]:
    """The units of a text; they are its marks and characters in order. An empty text has none."""
    return [u.replace(" ", MARK) for u in spaced(text)]


def unescape(text: str) -> str:
    parts = text.split(_ESC + _ESC)
    return _ESC.join(p.replace(_ESC + _ESC_MARK, MARK) for p in parts)


def decode(ids: list[int], raw: list[bytes]) -> str:
    """The text of ids: pieces one after the other, marks as spaces, but for the first."""
    text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")[1:]
    return unescape(text) if _ESC in text else text


def vocabulary(docs: DataFrame, cut: Callable[[str], list[str]] | None = None) -> DataFrame:
    """deal, uid, unit, n: the distinct units of all texts (or the parts that ``cut`` makes of them), partitioned by
    ``deal``, numbered, and how often they occur, counted in each task first."""

    tasks = shuffle_partitions(docs.sparkSession)
    n_deals = 8 * tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def flush() -> pa.RecordBatch:
            for u in [u for u in c if u[-1] in _ENDS] if cut else ():
                parts = cut(u)
                if len(parts) > 1:
                    n = c.pop(u)
                    for p in parts:
                        c[p] += n
            # a row for the parts that are dealt together; a line feed, a part by itself, is written as nothing
            dealt: dict[int, list[str]] = {}
            for u in c:
                dealt.setdefault(zlib.crc32(u.encode()) % n_deals, []).append(u)
            cols = [list(dealt), ["\n".join("" if u == "\n" else u for u in us) for us in dealt.values()], [[c[u] for u in us] for us in dealt.values()]]
            c.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.string(), pa.list_(pa.int64())), strict=True)], names=["deal", "units", "ns"])

        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(spaced(t.decode("utf-8", "replace")))
                if len(c) > COUNTED:
                    yield flush()
        yield flush()

    counted = small_batches(docs).select(text_or_empty().cast("binary").alias("t")).mapInArrow(run, "deal int, units string, ns array<bigint>")
    # dealt to a given number of partitions: the lattice of a small vocabulary is large
    dealt = counted.repartition(tasks, "deal")
    rows = dealt.select("deal", F.inline(F.arrays_zip(F.split("units", "\n", -1).alias("unit"), F.col("ns").alias("n"))))
    found = rows.groupBy("deal", "unit").agg(F.sum("n").alias("n"))
    unit = F.when(F.col("unit") == "", "\n").otherwise(F.translate("unit", " ", MARK))
    return found.select("deal", F.monotonically_increasing_id().alias("uid"), unit.alias("unit"), "n")


#: An edge as one number: its end, what its length lacks of LONGEST (so longer ones come first), and its piece; or, from
#: BYTES on, the code point of a character without a piece.
_END, _LACK, LONGEST, BYTES = 1 << 40, 1 << 32, 255, 1 << 31
#: First characters that say which longer pieces a place may begin.
_BEGINS = 4


def best_paths(unit: np.ndarray, edge: np.ndarray, chars: np.ndarray, score: np.ndarray, fallback: float) -> tuple[np.ndarray, np.ndarray]:
    """The best path of each unit: its edges' last 32 bits, unit by unit in order, and where each unit's begin.

    ``unit`` numbers the edges' units from 0, ``chars`` has their lengths. Of equal scores the longer last edge stays.
    """
    end, size, what = edge >> 40, LONGEST - (edge >> 32 & 255), edge & (_LACK - 1)
    first = np.cumsum(chars + 1) - chars - 1  # a unit's places lie side by side, with one before it
    to = first[unit] + end
    char = what >= BYTES
    cost = score[np.where(char, 0, what)]
    point = what[char] - BYTES
    # a character without a piece costs the fallback score for each of its bytes
    cost[char] = fallback * (1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
    places = int((chars + 1).sum())
    best, by, root = np.full(places, -np.inf), np.zeros(places, np.int64), np.zeros(places, bool)
    best[first], root[first] = 0, True
    kind = edge >> 32  # end, then length: of one kind a unit has one edge at most
    order = np.argsort(kind.astype(np.uint16) if len(kind) and kind.max() < 1 << 16 else kind, kind="stable")
    kind, to_, size_, cost_ = kind[order], to[order], size[order], cost[order]
    cuts = [0, *(np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist(), len(kind)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        t = to_[a:z]
        w = best[t - size_[a:z]] + cost_[a:z]
        up = w > best[t]
        best[t[up]], by[t[up]] = w[up], order[a:z][up]
    on, now = np.zeros(places, bool), first + chars
    while len(now):
        on[now] = True
        now = now - size[by[now]]
        now = now[~root[now]]
    taken = np.flatnonzero(on)
    return what[by[taken]], np.searchsorted(taken, np.append(first, places))


def encode_units(vocab: DataFrame, pieces: Pieces) -> DataFrame:
    """unit, n, ids, code (the ids as 16-bit numbers): the best segmentation of each unit of ``vocab`` (see :func:`vocabulary`).
    Ties go to the longer last piece.

    A start is exploded into the lengths that pieces with its first characters have, no longer ones; rows carry a
    unit's number and an edge's, and only the first of them the unit. A unit has fewer than 2 ** 23 characters.
    """
    spark = vocab.sparkSession
    table = spark.createDataFrame([(p, i) for p, i, _ in pieces.rows], "piece string, id long")  # bounded by the model
    texts, lengths = {p for p, _, _ in pieces.rows}, {}
    for p in texts:
        if _BEGINS <= len(p) <= LONGEST:
            lengths.setdefault(p[:_BEGINS], {1, *(x for x in range(2, _BEGINS) if p[:x] in texts)}).add(len(p))
    begun = spark.createDataFrame([(p, sorted(x)) for p, x in lengths.items()], "begins string, lengths array<int>")  # as well
    scores = np.zeros(len(pieces.raw))
    for _, i, w in pieces.rows:
        scores[i] = w

    longest = min(pieces.longest, LONGEST)
    starts = vocab.select("deal", "uid", "unit", "n", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("s"))
    starts = starts.select("deal", "uid", "s", F.when(F.col("s") == 0, F.struct("unit", "n")).alias("of"), F.expr(f"substring(unit, s + 1, {longest})").alias("rest"))
    subs = starts.join(F.broadcast(begun), F.substring("rest", 1, _BEGINS) == F.col("begins"), "left")
    subs = subs.select("deal", "uid", "s", "of", "rest", F.explode(F.coalesce("lengths", F.array(*map(F.lit, range(1, _BEGINS))))).alias("l"))
    subs = subs.where(F.col("l") <= F.length("rest")).select("deal", "uid", "s", "of", "l", F.expr("substring(rest, 1, l)").alias("sub"))
    edges = subs.join(F.broadcast(table), subs["sub"] == table["piece"], "left").where("id is not null or l = 1")
    piece = F.coalesce("id", F.lit(BYTES) + F.ascii("sub"))
    of = F.when(F.col("l") == 1, F.col("of"))
    edges = edges.select("deal", "uid", ((F.col("s") + F.col("l")).cast("long") * _END + (LONGEST - F.col("l")).cast("long") * _LACK + piece).alias("edge"), of["unit"].alias("unit"), of["n"].alias("n"))
    lattice = edges.groupBy("deal", "uid").agg(F.max("unit").alias("unit"), F.max("n").alias("n"), F.collect_list("edge").alias("edges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            many = pa.compute.list_value_length(b.column("edges")).to_numpy()
            chars = pa.compute.utf8_length(b.column("unit")).to_numpy().astype(np.int64)
            path, at = best_paths(np.repeat(np.arange(b.num_rows), many), b.column("edges").flatten().to_numpy(), chars, scores, pieces.fallback)
            if (path >= BYTES).any():
                ids = [[pieces.bytes[x] for x in chr(w - BYTES).encode()] if w >= BYTES else [w] for w in path.tolist()]
                at = np.cumsum([0, *map(len, ids)])[at]
                path = np.array([i for x in ids for i in x], np.int64)
            code = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer((2 * at).astype(np.int32)), pa.py_buffer(path.astype("<u2"))])
            ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(path.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("unit"), b.column("n"), ids, code], names=["unit", "n", "ids", "code"])

    return small_batches(lattice.select("unit", "n", "edges")).mapInArrow(run, "unit string, n bigint, ids array<int>, code binary")


def frequent(known: DataFrame, head: int) -> Column:
    """Holds for units of HEAD_CHARS characters at most that occur 2 ** (k / 8) times or more, with the least k that gives ``head`` or fewer."""
    short, k = F.length("unit") <= HEAD_CHARS, F.floor(8 * F.log2("n")).cast("int")
    sizes = {r["k"]: r["m"] for r in known.where(short).groupBy(k.alias("k")).agg(F.count("*").alias("m")).collect()}  # 504 rows at most
    least, total = 504, 0
    while least and total + sizes.get(least - 1, 0) <= head:
        least -= 1
        total += sizes.get(least, 0)
    return short & (k >= least)


def most_frequent(known: DataFrame, head: int) -> DataFrame:
    """The rows of ``known`` (unit, n) that are :func:`frequent`."""
    return known.where(frequent(known, head))


def encode(docs: DataFrame, model: str, head: int = HEAD) -> DataFrame:
    """doc_id, ids array<int>, n_tokens, n_units, exact (decoding the ids gives the text) for each row of ``docs``.

    Null text counts as empty and has no ids. A null doc_id stays null, repeated rows give a row each, other columns are
    ignored; an empty table gives an empty result.
    """
    pieces = Pieces(model)
    # from here on units have a space for the mark
    known = stored(encode_units(vocabulary(docs, pieces.cut), pieces).select(F.translate("unit", MARK, " ").alias("unit"), "n", "code"), "units")
    often = frequent(known, head)
    # at most ``head`` units of HEAD_CHARS characters; the most frequent ones get the smallest numbers
    got = known.where(often).toArrow().sort_by([("n", "descending"), ("unit", "ascending")])
    spark, codes = docs.sparkSession.sparkContext, got["code"].to_pylist()
    sent, sent_ids = spark.broadcast(got["unit"].to_pylist()), spark.broadcast((b"".join(codes), np.array([*map(len, codes)], "<u4").tobytes()))
    cache: dict = {}

    rare = bytes(4) + b"\1\0\0\0"

    class Numbers(dict):
        """Units to the numbers of their two parts, four bytes each. 0 is a part of no number, 1 a part that is not there."""

        def __init__(self):
            super().__init__((u, i.to_bytes(4, "little") + rare[4:]) for i, u in enumerate(sent.value, 2))
            self.most, self.lost = len(self) + REMEMBERED, {}  # the parts without a number by unit

        def __missing__(self, u: str) -> bytes:
            if u[-1] not in _ENDS:
                self.lost[u], self[u] = [u], rare
                return rare
            parts = pieces.cut(u)
            of = [(self.get(p) or rare)[:4] for p in parts]
            if rest := [p for p, x in zip(parts, of, strict=True) if x == rare[:4]]:
                self.lost[u] = rest
            self[u] = of[0] + (of[1] if len(of) > 1 else rare[4:])
            return self[u]

    def run(texts: list[bytes]) -> list[pa.Array]:
        packed, tails, count = [], [], []
        if "seen" not in cache or len(cache["seen"]) > cache["seen"].most:
            cache["seen"] = Numbers()
        seen, zip_ = cache["seen"], zstandard.ZstdCompressor(level=1)
        for t in texts:
            us = spaced(t.decode("utf-8", "replace"))
            planes = np.frombuffer(b"".join(map(seen.__getitem__, us)), np.uint8).reshape(-1, 8).T
            packed.append(zip_.compress(planes[[0, 1, 2, 4, 5, 6]].tobytes()))
            tails.append([p for u in filter(seen.lost.__contains__, us) for p in seen.lost[u]])
            count.append(len(us))
        return [pa.array(packed, pa.binary()), pa.array(tails, pa.list_(pa.string())), pa.array(count, pa.int64()), pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], pa.int64())]

    def tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = {(k, u) for k, us in zip(b.column("key").to_pylist(), b.column("tail").to_pylist(), strict=True) for u in us}
            keys, names = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(names, pa.string())], names=["key", "unit"])

    # documents that share a key share what was found for them, by part
    keyed = docs.select("doc_id", "text", F.hash("doc_id", text_or_empty()).alias("key"))
    # dealt out whole by key: the step below and the last join read the same shuffle
    parts = per_text(keyed, run, "packed binary, tail array<string>, n_units bigint, h bigint", ["doc_id", "key"]).repartition("key")
    wanted = parts.mapInArrow(tail, "key int, unit string")
    rest = wanted.join(known.where(~often).select("unit", "code"), "unit").select("key", "code").repartition("key")
    found = rest.groupBy("key").agg(F.collect_set("code").alias("found"))  # a part's ids spell it
    whole = parts.join(found, "key", "left").select("doc_id", "n_units", "h", "packed", "tail", "found")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, raw, mark, esc = zstandard.ZstdDecompressor(), pa.array(pieces.raw, pa.large_binary()), MARK.encode(), _ESC.encode()
        blob, sizes = sent_ids.value

        def lists(codes: bytes, sizes: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array((np.append(0, np.cumsum(sizes)) // 2).astype(np.int32)), pa.array(np.frombuffer(codes, "<u2").astype(np.int32)))

        def spelled(ids: pa.ListArray) -> list[bytes]:
            """The pieces of each list of ids one after the other, marks as spaces."""
            got = raw.take(ids.values)
            text, ends = memoryview(got.buffers()[2] or b""), np.frombuffer(got.buffers()[1], np.int64, len(got) + 1)[ids.offsets.to_numpy()].tolist()
            return [bytes(text[a:z]).replace(mark, b" ") for a, z in zip(ends[:-1], ends[1:], strict=True)]

        head_ids = lists(blob, np.append([0, 0], np.frombuffer(sizes, "<u4").astype(np.int64)))  # by number; the first two have none
        for b in (b.slice(i, BATCH) for b in batches for i in range(0, max(1, b.num_rows), BATCH)):
            h, packed, tails = (b.column(i).to_pylist() for i in (2, 3, 4))
            found = b.column(5)
            codes = found.flatten().to_pylist()
            others = lists(b"".join(codes), np.array([*map(len, codes)], np.int64))
            names = spelled(others)
            many = pa.compute.fill_null(pa.compute.list_value_length(found), 0).to_pylist()
            number, rest, at = [np.zeros(0, np.uint32)], [], 0
            for z, tail, m in zip(packed, tails, many, strict=True):
                planes = np.frombuffer(unzip.decompress(z, max_output_size=1 << 31) if z else b"", np.uint8).reshape(2, 3, -1).astype(np.uint32)
                number.append((planes[:, 0] | planes[:, 1] << 8 | planes[:, 2] << 16).T.ravel())
                if tail:
                    of = dict(zip(names[at : at + m], range(at, at + m), strict=True))
                    rest.extend([of[u.encode()] for u in tail])
                at += m
            parts = np.concatenate(number)
            parts[parts == 0] = len(head_ids) + np.array(rest, np.uint32)
            of_parts = pa.concat_arrays([head_ids, others]).take(pa.array(parts))
            ids = of_parts.flatten()
            cuts = (of_parts.offsets.to_numpy() - of_parts.offsets[0].as_py())[np.cumsum([len(x) for x in number])]
            exact = []
            for t, x in zip(spelled(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), ids)), h, strict=True):
                t = t[1:]
                exact.append(xxhash.xxh3_64_intdigest(unescape(t.decode("utf-8", "replace")).encode() if esc in t else t) - (1 << 63) == x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), ids), pa.array(np.diff(cuts).astype(np.int64)), b.column(1), pa.array(exact, pa.bool_())], names=["doc_id", "ids", "n_tokens", "n_units", "exact"])

    return whole.mapInArrow(finish, f"doc_id {id_type}, ids array<int>, n_tokens bigint, n_units bigint, exact boolean")
