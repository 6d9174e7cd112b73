"""Run a registered Spark query and its DuckDB oracle; compare as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark_df, sql: str, con) -> dict:
    rel = con.sql(sql)
    duck_cols = rel.columns
    duck_types = [str(t) for t in rel.types]
    duck_rows = rel.fetchall()
    spark_cols = spark_df.columns
    spark_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    spark_rows = [tuple(r) for r in spark_df.collect()]
    out = {
        "spark_rows": len(spark_rows),
        "oracle_rows": len(duck_rows),
        "columns_match": sorted(spark_cols) == sorted(duck_cols),
    }
    s_types = dict(zip(spark_cols, [SPARK_TO_DUCK.get(t, t) for t in spark_types]))
    d_types = dict(zip(duck_cols, duck_types))
    out["type_mismatch"] = {
        c: (s_types[c], d_types.get(c)) for c in spark_cols if s_types[c] != d_types.get(c)
    }
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(spark_cols) - set(duck_cols))
        out["oracle_only"] = sorted(set(duck_cols) - set(spark_cols))
        out["values_match"] = False
        return out
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    out["values_match"] = s == d
    if not out["values_match"]:
        ss, dd = set(s), set(d)
        out["spark_not_oracle"] = [r for r in s if r not in dd][:3]
        out["oracle_not_spark"] = [r for r in d if r not in ss][:3]
    return out
