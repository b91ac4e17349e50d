"""E1 canonical form and change hash, as built-in expressions.

Canonical text: a flat JSON object with keys sorted, compact separators,
non-ASCII kept, and only null and false values dropped (0, "" and [] stay).
``to_json`` already omits null fields and writes compact JSON, so mapping
``false`` to null and fixing the field order alphabetically gives the same
bytes as ``json.dumps(sort_keys=True, separators=(",", ":"), ensure_ascii=False)``
over the dict without None/False values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _drop_false(c: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit(True))
    return c


def canonical_json(fields: dict[str, Column], types: dict[str, T.DataType] | None = None) -> Column:
    """``fields`` name -> value column; booleans listed in ``types`` lose their false."""
    types = types or {}
    parts = [_drop_false(fields[k], types.get(k)).alias(k) for k in sorted(fields)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def change_hash(fields: dict[str, Column], types: dict[str, T.DataType] | None = None) -> Column:
    """SHA-256 hex of the canonical text."""
    return F.sha2(canonical_json(fields, types), 256)
