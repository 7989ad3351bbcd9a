"""Side-by-side comparison of a Spark result with its SQL result."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(table) -> tuple[list[str], list[tuple]]:
    """(sorted column names, sorted rows) of an Arrow table."""
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_norm(v) for v in r) for r in zip(*cols)]
    coarse = [tuple(f"{v:.3g}" if isinstance(v, float) else repr(v) for v in r) for r in rows]
    return names, [r for _, r in sorted(zip(coarse, rows), key=lambda p: (p[0], repr(p[1])))]


def _same(x, y, tol: float) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return x == y or abs(x - y) <= tol
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_same(a, b, tol) for a, b in zip(x, y))
    return x == y


def difference(spark_table, sql_table, tol: float = 0.0) -> str | None:
    """First difference as text, None when the results agree.

    `tol` admits one unit of the last rounded digit: a mean that lies exactly on a rounding
    boundary may go either way with the order of summation."""
    a_names, a = rows_of(spark_table)
    b_names, b = rows_of(sql_table)
    if a_names != b_names:
        return f"columns {a_names} vs {b_names}"
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)} rows"
    for x, y in zip(a, b):
        if not _same(x, y, tol):
            return f"spark {x} vs sql {y} on {a_names}"
    return None
