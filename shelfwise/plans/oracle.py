"""Compare a Spark result with its DuckDB oracle (tests and the checker
script). DuckDB is only needed here, imported lazily."""

from __future__ import annotations

import datetime as dt
import decimal
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
    "date": "DATE",
}


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    return v


def _sorted_rows(rows):
    return sorted((tuple(_canon(v) for v in r) for r in rows), key=repr)


def compare(sdf, sql: str, con) -> list[str]:
    """Problems found (empty when equal): column names, types, row count,
    order-insensitive values."""
    s_cols = [f.name for f in sdf.schema.fields]
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = [str(d[1]) for d in rel.description]
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns spark={s_cols} duckdb={d_cols}"]
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    d_types = [d_types[i] for i in order]
    if s_types != d_types:
        problems.append(f"types spark={s_types} duckdb={d_types}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duckdb={len(d_rows)}")
        return problems
    a, b = _sorted_rows(s_rows), _sorted_rows(d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
