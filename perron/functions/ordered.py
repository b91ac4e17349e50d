"""Ordered first/last aggregates (Oracle ``KEEP (DENSE_RANK FIRST/LAST)``).

Spark has ``min_by``/``max_by`` but their tie-break is not deterministic and
they need a single order key. Packing the order keys and the payload into a
struct and taking ``min``/``max`` of the struct is deterministic, handles
several order keys, keeps null payloads of the winning row, and aggregates
partially on the map side (no sort of whole groups, no window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_row(order: Sequence, payload: Sequence[str]) -> Column:
    """Struct of the row with the lowest ``order`` (then lowest payload)."""
    fields = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    fields += [F.col(p).alias(p) for p in payload]
    return F.min(F.struct(*fields))


def last_row(order: Sequence, payload: Sequence[str]) -> Column:
    """Struct of the row with the highest ``order`` (then highest payload)."""
    fields = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    fields += [F.col(p).alias(p) for p in payload]
    return F.max(F.struct(*fields))


def keep_last_max(order: Sequence, value) -> Column:
    """``max(value) KEEP (DENSE_RANK LAST ORDER BY order)``.

    Ties on ``order`` resolve to the largest non-null value (a null loses
    against any non-null value inside the tie, as in the reference).
    """
    v = F.col(value) if isinstance(value, str) else value
    fields = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    return F.max(F.struct(*fields, v.alias("_v")))["_v"]


def keep_first_min(order: Sequence, value) -> Column:
    """``min(value) KEEP (DENSE_RANK FIRST ORDER BY order)``: smallest non-null in the tie."""
    v = F.col(value) if isinstance(value, str) else value
    fields = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    return F.min(F.struct(*fields, v.isNull().alias("_n"), v.alias("_v")))["_v"]


def _sort_fields(df, order) -> list[Column]:
    """Ascending struct fields that order rows like ``order``.

    ``order``: column names (ascending, nulls first) or ``(name, "desc")``
    (descending, nulls last). Descending keys are negated, so only numeric,
    date, timestamp and boolean columns can be descending.
    """
    from pyspark.sql import types as T
    out: list[Column] = []
    for i, o in enumerate(order):
        name, direction = (o, "asc") if isinstance(o, str) else o
        c = F.col(name)
        if direction == "asc":
            out.append(c.alias(f"_k{i}"))
            continue
        dt = df.schema[name].dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            neg = -F.unix_micros(c.cast("timestamp"))
        elif isinstance(dt, T.DateType):
            neg = -F.unix_date(c)
        elif isinstance(dt, T.BooleanType):
            neg = -c.cast("int")
        elif isinstance(dt, T.NumericType):
            neg = -c
        else:
            raise TypeError(f"descending order on {dt} is not supported: {name}")
        out.append(c.isNull().alias(f"_n{i}"))
        out.append(neg.alias(f"_k{i}"))
    return out


def top1(df, keys: Sequence[str], order) -> "DataFrame":  # noqa: F821
    """The first row per ``keys`` under ``order`` (remaining ties: the smallest row).

    One grouped ``min`` over a struct of (sort keys, whole row): it combines
    partially on the map side, so a key with very many copies is reduced in
    every input task before the shuffle -- unlike a ``row_number`` window,
    which sends all copies of a key to one task and sorts them there. Keys are
    the grouped columns themselves, so a later filter on them is applied before
    the grouping and they are not shuffled twice; nor are columns that rows are
    ordered by rising, which are taken from the sort keys.
    """
    from pyspark.sql import types as T
    # grouping makes -0.0 and 0.0 one: fractional keys are taken from the row, as they were
    plain = [k for k in keys if k in df.columns and not isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType, T.ArrayType, T.StructType))]
    at = {c: f"_m._row.{c}" for c in df.columns} | {o if isinstance(o, str) else o[0]: f"_m._k{i}" for i, o in enumerate(order) if isinstance(o, str) or o[1] == "asc"}
    row = F.struct(*[F.col(c) for c in df.columns if c not in plain and at[c].startswith("_m._row.")] or [F.lit(0).alias("_none")]).alias("_row")
    m = df.groupBy(*keys).agg(F.min(F.struct(*_sort_fields(df, order), row)).alias("_m"))
    return m.select(*[F.col(c) if c in plain else F.col(at[c]).alias(c) for c in df.columns])
