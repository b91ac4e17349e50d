"""Best-fit packing of tokenised documents into sequences of bounded length.

Bounded-space online best-fit: a task holds a fixed number of open bins, kept in a bitset keyed by free space.
A piece goes to the open bin that it fills best; when none has room a bin is opened, and when more than
``open_bins`` are open the fullest closes first. What is still open at a task's end is not closed: these bins go on
as units to the next round, which has ``fan_in`` times fewer tasks, so that only the last round leaves open bins.
No task holds more than ``open_bins`` bins at a time and none sees all pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import per_text, shuffle_partitions, stored

LENGTH = 2048
EOD = 0
#: Texts encoded at once, and chunks whose ids a Python worker remembers in each of two generations.
BATCH, REMEMBERED = 256, 400_000
#: New chunks encoded as one text.
JOINED = 1000
_MARKS = ".,;:!?"


@cache
def _encoder(path: str) -> "Encoder":
    return Encoder(path)


class Encoder:
    """Little-endian 32-bit ids of texts.

    The tokenizer's pattern starts a new token at a space or line feed between two other characters and between a
    letter or digit and a punctuation mark after it, so a text's ids are those of its chunks one after the other, and
    most chunks have been seen before. Texts with other white space beside such a place are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # the same model for words written byte by byte as its tokens are: a space as Ġ, a line feed, which parts them, as Ċ
        self.words = Tokenizer(self.tok.model)
        self.words.pre_tokenizer = pre_tokenizers.Split("Ċ", "isolated")
        self.feed = self.tok.encode("\n", add_special_tokens=False).ids[0]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.odd: set[str] = set()  # chunks that may not stand alone

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks without a line feed or white space at either end but a leading space: JOINED at a time as one
        text with line feeds between, each of which is a token of its own there. What is ASCII letters is one word of the
        pattern and its bytes are written as themselves, so neither the pattern nor the bytes need work."""
        of: dict[str, bytes] = {}
        words, others = [], []
        for c in chunks:
            (words if c.isascii() and c[c[0] == " " :].isalpha() else others).append(c)
        for kind, tok, feed, space in ((words, self.words, "Ċ", "Ġ"), (others, self.tok, "\n", " ")):
            for i in range(0, len(kind), JOINED):
                some = kind[i : i + JOINED]
                ids = np.array(tok.encode_batch_fast([feed.join(some).replace(" ", space)], add_special_tokens=False)[0].ids, "<u4")
                ends, raw = np.flatnonzero(ids == self.feed).tolist(), ids.tobytes()
                cuts = zip([0, *(z + 1 for z in ends)], [*ends, len(ids)], strict=True)
                of.update(zip(some, [raw[4 * a : 4 * z] for a, z in cuts] if len(ends) == len(some) - 1 else self._plain(some), strict=True))
        return of

    def _learn(self, chunks: set[str]) -> None:
        young, old = self.young, self.old
        split: dict[str, tuple[str, str]] = {}
        new: set[str] = set()
        seen = set(filter(old.__contains__, chunks))
        young.update(zip(seen, map(old.__getitem__, seen), strict=True))
        for c in chunks.difference(seen):
            if c[-1:].isalpha() and (c[0] == " " or c[0].isalpha()):  # most of them: neither odd nor with a mark at the end
                new.add(c)
                continue
            if c != "\n" and (not c or c[-1].isspace() or (c[0] != " " and c[0].isspace())):
                self.odd.add(c)
                young[c] = b""
                continue
            word = c.rstrip(_MARKS)
            if len(word) < len(c) and word and word[-1].isalnum():
                split[c] = (word, c[len(word) :])
                new.update(x for x in split[c] if x not in young)
            else:
                new.add(c)
        seen = set(filter(old.__contains__, new))
        young.update(zip(seen, map(old.__getitem__, seen), strict=True))
        todo = list(new.difference(seen))
        if "\n" in todo:
            todo.remove("\n")
            young["\n"] = self.feed.to_bytes(4, "little")
        young.update(self._apart(todo))
        young.update((c, young[w] + young[m]) for c, (w, m) in split.items())

    def __call__(self, raw: list[bytes]) -> list[bytes]:
        texts = [t.decode("utf-8", "replace") for t in raw]
        chunked = [t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if t else [] for t in texts]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        self._learn(set().union(*chunked).difference(self.young))
        whole = [i for i, (t, c) in enumerate(zip(texts, chunked, strict=True)) if "\0" in t or (self.odd and not self.odd.isdisjoint(c))]
        out = [b"".join(map(self.young.__getitem__, c)) for c in chunked]
        for i, ids in zip(whole, self._plain([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short of ``length``."""
    first = n if n <= length else n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def tokenize_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) for every piece of every document; null text counts as empty."""

    def run(texts: list[bytes]) -> list[pa.Array]:
        rows, offsets, crc, ids = [], [0], [], []
        encode = _encoder(tokenizer)
        for b in (x for i in range(0, len(texts), BATCH) for x in encode(texts[i : i + BATCH])):
            b += EOD.to_bytes(4, "little")
            for k, (s, m) in enumerate(cut(len(b) // 4, length)):
                rows.append((k, s, m))
                part = b[4 * s : 4 * (s + m)]
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            offsets.append(len(rows))
        a = np.array(rows, np.int64).reshape(-1, 3)
        fields = [pa.array(a[:, 0].astype(np.int32)), pa.array(a[:, 1]), pa.array(a[:, 2]), pa.array(np.array(crc, np.int64))]
        names = ["piece", "start", "length", "ids_crc32"]
        if with_ids:
            fields.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names))]

    kind = "piece:int,start:bigint,length:bigint,ids_crc32:bigint" + (",ids:array<int>" if with_ids else "")
    made = per_text(docs, run, f"pieces array<struct<{kind}>>", ["doc_id"])
    return made.select("doc_id", F.inline("pieces"))


class OpenBins:
    """At most ``limit`` open bins; bit f of ``free`` is set while some open bin has f places left."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit, self.free, self.count = length, limit, 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _put(self, room: int, items: list) -> None:
        self.by_free.setdefault(room, []).append(items)
        self.free |= 1 << room
        self.count += 1

    def _take(self, room: int) -> list:
        bins = self.by_free[room]
        items = bins.pop()
        if not bins:
            self.free &= ~(1 << room)
        self.count -= 1
        return items

    def add(self, item, size: int) -> list[list]:
        """Places an item; the bins that this closes."""
        fits = self.free >> size
        room = size + (fits & -fits).bit_length() - 1 if fits else self.length
        items = self._take(room) if fits else []
        items.append(item)
        if room == size:
            return [items]
        self._put(room - size, items)
        # the fullest is the one with the least free space
        return [self._take((self.free & -self.free).bit_length() - 1)] if self.count > self.limit else []

    def rest(self) -> list[list]:
        out = [b for room in sorted(self.by_free) for b in self.by_free[room]]
        self.__init__(self.length, self.limit)
        return out


def _round(units: DataFrame, tasks: int, length: int, open_bins: int, last: bool) -> DataFrame:
    """Packs (unit, size) rows: unit, size, bin, offset, and done = the bin closed in this round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, rows = OpenBins(length, open_bins), []

        def close(items: list, done: bool) -> None:
            at = 0
            for unit, size in items:
                rows.append((unit, size, items[0][0], at, done))  # a bin is called after its first unit
                at += size

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.bool_()], strict=True)], names=["unit", "size", "bin", "offset", "done"])

        for b in batches:
            for unit, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for items in bins.add((unit, size), size):
                    close(items, True)
            yield flush()
        for items in bins.rest():
            close(items, last)
        yield flush()

    # a fixed number of tasks and a total order inside them: a task that runs again packs the same
    dealt = units.repartition(tasks, "unit").sortWithinPartitions(F.xxhash64("unit"), "unit")
    return dealt.mapInArrow(run, "unit bigint, size bigint, bin bigint, offset bigint, done boolean")


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = 256, pieces_per_task: int = 200_000, fan_in: int = 32) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset (place in the sequence, gapless from 0).

    Every piece gets one place and no sequence is over ``length``; a piece must not be longer than that. Repeated
    rows are packed as often as they occur. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    units = stored(pieces.withColumn("unit", F.monotonically_increasing_id()), "pieces")
    total = units.count()
    tasks = max(1, min(shuffle_partitions(spark), -(-total // pieces_per_task)))
    place = units.select("unit", F.col("length").alias("size"))
    final = None
    at = units.select("unit", F.col("unit").alias("bin"), F.lit(0).cast("bigint").alias("offset"))
    open_units = place
    while True:
        packed = stored(_round(open_units, tasks, length, open_bins, tasks == 1), "packed")
        # what this round moved: a unit (a piece or an open bin) now has a place in a bin of this round
        step = packed.select(F.col("unit").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("by"), "done")
        moved = at.join(step, "bin").select("unit", F.col("to").alias("bin"), (F.col("offset") + F.col("by")).alias("offset"), "done")
        closed = moved.where("done").drop("done")
        final = closed if final is None else final.union(closed)
        if tasks == 1:
            break
        at = stored(moved.where(~F.col("done")).drop("done"), "open")
        open_units = packed.where(~F.col("done")).groupBy(F.col("bin").alias("unit")).agg(F.sum("size").alias("size"))
        tasks = max(1, tasks // fan_in)
    return units.join(final.withColumnRenamed("bin", "sequence_id"), "unit").drop("unit")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, open_bins: int = 256, with_ids: bool = False) -> DataFrame:
    """Tokenises, cuts and packs ``docs`` (doc_id, text); see :func:`tokenize_pieces` and :func:`pack`.

    A null doc_id stays null, null text is one end-of-document id, repeated rows are packed each, other columns are
    ignored.
    """
    return pack(tokenize_pieces(docs, tokenizer, length, with_ids), length, open_bins)
