"""DuckDB oracle SQL, one statement per registered query."""

import importlib

_MODULES = ["oracle.gold_sql", "oracle.reports_sql", "oracle.dims_traces_sql", "oracle.tableops_sql", "oracle.silver_sql", "oracle.live_sql", "oracle.files_sql", "oracle.station_sql", "oracle.ops_sql"]


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        try:
            out.update(importlib.import_module(m).SQL)
        except ModuleNotFoundError:
            pass
    return out
