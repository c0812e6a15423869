"""Order-insensitive comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

INPUTS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(directory: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in INPUTS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, bool) or v is None:
        return v
    return str(v)


def rows_of(names, records) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in records)


def difference(df, con, sql: str, shown: int = 4) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, expected = rows_of(df.columns, df.collect()), rows_of(names, expected_rows)
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; "
        f"{sum(extra.values())} unexpected {list(extra)[:shown]}; {sum(missing.values())} missing {list(missing)[:shown]}"
    )
