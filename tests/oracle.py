"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

DATA = os.environ.get("FOLIUM_TESTDATA", "/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings page_blocks portions bundle_runs bundle_entries provenance_blocks preview_blocks subjects subject_labels mix_targets".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return plain(float(v)) if v != int(v) else int(v)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)


def rows_of_sql(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
