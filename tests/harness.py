"""Oracle harness mirroring the driver's check: row count, schema, value hash.

Columns are sorted by name; rows are compared order-insensitively.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _canon(v.asDict())
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return cols, out


def digest(lines: list[str]) -> str:
    h = hashlib.sha256()
    for ln in lines:
        h.update(ln.encode())
        h.update(b"\n")
    return h.hexdigest()


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT": "float",
                 "SMALLINT": "smallint", "HUGEINT": "hugeint", "FLOAT[]": "array<float>",
                 "DOUBLE[]": "array<double>", "VARCHAR[]": "array<string>", "BIGINT[]": "array<bigint>"}


def compare(spark_df, con, sql: str) -> dict:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    stypes = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in res.description}
    drows = res.fetchall()
    type_diff = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                 if stypes.get(c) != dtypes.get(c)}
    sc, sl = canonical(scols, srows)
    dc, dl = canonical(dcols, drows)
    out = {"spark_rows": len(sl), "oracle_rows": len(dl), "schema_match": sc == dc,
           "spark_cols": sc, "oracle_cols": dc, "hash_match": digest(sl) == digest(dl), "type_diff": type_diff}
    if not out["hash_match"]:
        sset, dset = set(sl), set(dl)
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_oracle"] = sorted(dset - sset)[:3]
    return out
