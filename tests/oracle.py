"""Compare a registered query with its oracle."""

from __future__ import annotations

import duckdb

from assetboard.sources.stand_ins import TABLES


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    # Beside Spark in one process: few threads and bounded memory.
    con.execute("set threads = 2")
    con.execute("set memory_limit = '2GB'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _rows(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return names, types, sorted(zip(*columns), key=repr) if columns else []


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; an empty list is an exact match."""
    result = con.execute(sql)
    expected = result.to_arrow_table() if hasattr(result, "to_arrow_table") else result.fetch_arrow_table()
    got_names, got_types, got = _rows(df.toArrow())
    want_names, want_types, want = _rows(expected)
    problems = []
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    for n, g, w in zip(got_names, got_types, want_types):
        if g != w:
            problems.append(f"type of {n}: {g} != {w}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    diff = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if diff:
        problems.append(f"{len(diff)} rows differ, e.g. {diff[0][0]} != {diff[0][1]}")
    if not got:
        problems.append("no rows")
    return problems
