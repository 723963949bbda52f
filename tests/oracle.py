"""Compare a registered query with its SQL on DuckDB over the same parquet files."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return ("n", "nan")
        return ("n", round(f, 6) + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("d", str(v)[:26])
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    return ("s", str(v))


def kind(name: str) -> str:
    n = name.lower()
    if any(x in n for x in ("hugeint", "decimal")):
        return n.split("(")[0]
    if any(x in n for x in ("bigint", "long")):
        return "int64"
    if any(x in n for x in ("integer", "int")):
        return "int32"
    if any(x in n for x in ("double", "float")):
        return "double"
    if any(x in n for x in ("varchar", "string")):
        return "string"
    return n


def key(row):
    return tuple(str(x) for x in row)


def compare(spark_df, con, sql: str):
    """(ok, message)."""
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: kind(str(c[1])) for c in cur.description}
    d_rows = cur.fetchall()
    s_cols = spark_df.columns
    s_types = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(d_cols) != sorted(s_cols):
        return False, f"columns {sorted(s_cols)} vs {sorted(d_cols)}"
    order = sorted(s_cols)
    si, di = [s_cols.index(c) for c in order], [d_cols.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in s_rows), key=key)
    b = sorted((tuple(norm(r[i]) for i in di) for r in d_rows), key=key)
    if len(a) != len(b):
        sa, sb = set(a), set(b)
        extra, missing = [x for x in a if x not in sb][:2], [x for x in b if x not in sa][:2]
        return False, f"rows {len(a)} vs {len(b)}; only spark {extra}; only sql {missing}; order {order}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return False, f"{len(bad)} of {len(a)} rows differ, order {order}, first:\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    types = {c: (s_types[c], d_types[c]) for c in order if s_types[c] != d_types[c]}
    return (not types), (f"{len(a)} rows" + (f" TYPES {types}" if types else ""))
