"""B8 loud narrowing: wide text to typed columns in one pass, with every value that does not fit named.

Each column has a type, or a greatest length in characters. A value that cannot be cast, or is too long, is a fault of its
row: column, reason and value. Rows with faults go to quarantine; a write without quarantine fails after the pass, with
the number of faults by column and reason in its message. Nothing is cut or silently set to null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the faults of a row are kept until it is split.
FAULTS = "faults__"
KIND = "array<struct<column_name:string,reason:string,value:string>>"


class NarrowingError(ValueError):
    """Values that do not fit their columns."""


def _fault(name: str, kind: str | int) -> Column:
    c = F.col(name).cast("string")
    if isinstance(kind, int):
        bad, reason = F.length(c) > kind, f"longer than {kind}"
    else:
        bad, reason = c.isNotNull() & c.try_cast(kind).isNull(), f"not a {kind}"
    return F.when(bad, F.struct(F.lit(name).alias("column_name"), F.lit(reason).alias("reason"), c.alias("value")))


def narrowed(rows: DataFrame, kinds: dict[str, str | int]) -> DataFrame:
    """``rows`` with the columns of ``kinds`` cast (a number is a greatest length) and the row's FAULTS. Nulls fit everywhere."""
    faults = F.filter(F.array(*[_fault(c, k) for c, k in kinds.items()]), lambda x: x.isNotNull()).cast(KIND)
    cols = [F.col(c).cast("string").try_cast(kinds[c]).alias(c) if isinstance(kinds.get(c), str) else F.col(c) for c in rows.columns]
    return rows.select(*cols, faults.alias(FAULTS))


def split(checked: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows without faults, quarantine: keys, column_name, reason, value of each fault) of :func:`narrowed` rows."""
    good = checked.where(F.size(FAULTS) == 0).drop(FAULTS)
    return good, checked.where(F.size(FAULTS) > 0).select(*keys, F.inline(FAULTS))


def write_narrowed(rows: DataFrame, kinds: dict[str, str | int], path: str, keys: list[str], quarantine: bool = False) -> tuple[DataFrame, DataFrame]:
    """Narrows and writes ``rows`` in one pass; returns what :func:`split` makes of the stored rows.

    Without ``quarantine`` any fault raises NarrowingError once all rows have been looked at.
    """
    checked = narrowed(rows, kinds)
    checked.write.parquet(path)
    stored = rows.sparkSession.read.schema(checked.schema).parquet(path)
    good, bad = split(stored, keys)
    if not quarantine:
        found = bad.groupBy("column_name", "reason").agg(F.count("*").alias("n"), F.min("value").alias("least")).orderBy("column_name", "reason").collect()  # columns x reasons
        if found:
            raise NarrowingError("; ".join(f"{r['column_name']}: {r['n']} {r['reason']} (such as {r['least']!r})" for r in found))
    return good, bad
