"""Secret scans: single findings and multipart credentials.

Three kinds of part are found alone: assignments, access identifiers and long hexadecimal strings. Weak candidates
(a bare key-like string, a service endpoint, a short access identifier) mean nothing alone. They are reported only
when complementary parts occur in one scope, within ``scope`` code points of them: a secret with an identifier or an
identifier with a secret on the pair alone, an endpoint with both. The interval join runs in Spark: parts are dealt to bins as wide as a scope, each bin keeps the
extreme positions per role, and a candidate is joined with its own and the two neighbouring bins. Nearest partners
are thus found without pairing the members of a group, and a bin holds at most ``scope`` parts, however long the
text.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import per_text, stored

#: The patterns of the base kinds, in the order in which spans of one start are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
#: Weak parts. A key has 40 characters of base 64 of all three kinds; an endpoint names a service host.
KEY = re.compile(r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[a-z])(?=[A-Za-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]{4,}|\b(?:s3|sts|api|auth|iam)[.-][a-z0-9-]+\.[a-z0-9.-]*[a-z]", re.ASCII)
IDENTIFIER = re.compile(r"\b(?:client|user|account|access|key)_?id[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]{4,})", re.IGNORECASE | re.ASCII)
#: kind, pattern, role in a credential, found alone
KINDS = [("assign", "secret", True), ("access", "identifier", True), ("hex", "secret", True),
         ("key", "secret", False), ("endpoint", "endpoint", False), ("identifier", "identifier", False)]
ROLE = {k: r for k, r, _ in KINDS}
ORDER = {k: i for i, (k, _, _) in enumerate(KINDS)}
SCOPE = 400


def find(text: str) -> list[tuple[str, int, int]]:
    """All parts of a text as (kind, start, end), code points, end exclusive, by start and kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # a run of 32 or more is found whole by a greedy pattern, so shorter runs need not be listed
    out += [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(text)]
    starts, ends = _merged([(s, e) for _, s, e in out])
    for kind, pat in (("key", KEY), ("endpoint", ENDPOINT), ("identifier", IDENTIFIER)):
        for m in pat.finditer(text):
            i = bisect_right(ends, m.start())  # the first that ends behind the start
            if i == len(starts) or starts[i] >= m.end():
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], ORDER[x[0]]))


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover, rising."""
    starts, ends = [], []
    for s, e in sorted(spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s), ends.append(e)
    return starts, ends


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, row (one number per input row), parts array of (kind, start, end) in text order."""

    def run(texts: list[bytes]) -> list[pa.Array]:
        kind, start, end, offsets = [], [], [], [0]
        for t in texts:
            for k, s, e in find(t.decode("utf-8", "replace")):
                kind.append(k), start.append(s), end.append(e)
            offsets.append(len(kind))
        inner = pa.StructArray.from_arrays([pa.array(kind, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["kind", "start", "end"])
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)]

    made = per_text(docs, run, "parts array<struct<kind:string,start:bigint,end:bigint>>", ["doc_id"])
    return made.withColumn("row", F.monotonically_increasing_id())


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, kind, start, end of weak parts that have their partners within ``scope``.

    Distance is from start to start. A weak secret needs an identifier, a weak identifier a secret, an endpoint one of
    each; parts that are found alone count as partners too.
    """
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    p = found.select("row", F.inline("parts")).withColumn("role", role[F.col("kind")]).withColumn("bin", F.floor(F.col("start") / scope).cast("long"))
    near = p.groupBy("row", "bin", "role").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    weak = p.where(F.col("kind").isin([k for k, _, alone in KINDS if not alone]))
    look = weak.withColumn("at", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    n = near.select("row", F.col("bin").alias("at"), F.col("role").alias("other"), "lo", "hi")
    # in a bin below the candidate's the last part is nearest, in one above the first; in its own all are near
    # an endpoint completes no pair, so it is nobody's partner
    ok = ((F.col("other") != F.col("role")) & (F.col("other") != "endpoint")
          & F.when(F.col("at") < F.col("bin"), F.col("start") - F.col("hi") <= scope)
             .when(F.col("at") > F.col("bin"), F.col("lo") - F.col("start") <= scope).otherwise(True))
    hit = look.join(n, ["row", "at"]).where(ok)
    return (hit.groupBy("row", "kind", "start", "end").agg(F.count_distinct("other").alias("roles"))
            .where(F.col("roles") == F.when(F.col("kind") == "endpoint", 2).otherwise(1)).drop("roles"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, spans array<struct<start, ord, kind, end>> by start, then kind: one row for each row of ``docs``.

    A weak part that overlaps a base span is none; reported parts of different kinds may overlap, and of equal starts the
    kind that is listed first comes first. Null and empty texts have no spans, a null doc_id stays null, repeated rows give a row each, other columns are
    ignored.
    """
    found = stored(parts(docs), "secrets")
    order = F.create_map(*[F.lit(x) for kv in ORDER.items() for x in kv])
    spans = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end")))
    linked = link(found, scope).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("weak"))
    alone = F.filter("parts", lambda x: x["kind"].isin([k for k, _, a in KINDS if a]))
    return (found.join(linked, "row", "left")
            .select("doc_id", F.array_sort(spans(F.concat(alone, F.coalesce("weak", F.filter("parts", lambda x: F.lit(False)))))).alias("spans")))


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of op3 from the spans of :func:`scan`."""
    base = F.filter("spans", lambda x: x["ord"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with every reported span of its text replaced by ``mark``.

    Overlapping spans are replaced once. Documents are matched by doc_id and, for repeated ids, by text; rows without
    spans pass unchanged, and n_chars, if there, follows the text.
    """
    from perron.llm.base import fresh

    ids = docs.select("doc_id", "text")
    dirty = scan_texts(ids, scope)
    key, spans = fresh(docs, "h__"), fresh(docs, "spans__")
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    right = dirty.select(F.col("h").alias(key), F.col("spans").alias(spans)).dropDuplicates([key])
    out = marked.join(right, key, "left")
    # four bytes a code point, so that a cut takes no walk over the text
    raw = fresh(docs, "raw__")
    out = out.withColumn(raw, F.when(F.col(spans).isNotNull(), F.encode("text", "UTF-32")))
    between = lambda a, b: F.decode(F.substring(F.col(raw), (a * 4 + 1).cast("int"), (b - a).cast("int") * 4), "UTF-32")
    start = F.struct(F.expr("cast(array() as array<string>)").alias("t"), F.lit(0).cast("bigint").alias("at"))
    folded = F.aggregate(F.col(spans), start, lambda a, x: F.struct(
        F.when(x["start"] < a["at"], a["t"]).otherwise(F.concat(a["t"], F.array(between(a["at"], x["start"]), F.lit(mark)))).alias("t"),
        F.greatest(a["at"], x["end"]).alias("at")))
    text = F.concat(F.array_join(folded["t"], ""), between(folded["at"], F.length(raw) / 4))
    cols = [F.when(F.col(spans).isNull(), F.col("text")).otherwise(text).alias("text") if c == "text"
            else F.col(c) for c in docs.columns]
    out = out.select(*cols)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def scan_texts(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """h (hash of doc_id and text) and spans of the rows that have any; for writing results back to texts."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    return scan(keyed, scope).where(F.size("spans") > 0).withColumnRenamed("doc_id", "h")
