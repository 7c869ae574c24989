"""Compare a Spark query result with its SQL oracle (test helper).

Mirrors the correctness gate: column names sorted, row counts, column types
and an order-insensitive comparison of values (doubles compared after rounding).
Only used on small fixtures; results are brought to the driver here on purpose.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from quire.sources.fixtures import TABLES


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(
            f"create or replace view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')"
        )
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    return "other"


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> list[str]:
    problems = []
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        problems.append(f"columns {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}")
        return problems
    if len(spark_pdf) != len(oracle_pdf):
        problems.append(f"rows {len(spark_pdf)} vs {len(oracle_pdf)}")
    for c in spark_pdf.columns:
        a, b = _kind(spark_pdf[c].dtype), _kind(oracle_pdf[c].dtype)
        if a != b and not (len(spark_pdf) == 0 or len(oracle_pdf) == 0):
            problems.append(f"type {c}: {spark_pdf[c].dtype} vs {oracle_pdf[c].dtype}")
    if not problems:
        ra, rb = _rows(spark_pdf), _rows(oracle_pdf)
        if ra != rb:
            bad = next(i for i, (x, y) in enumerate(zip(ra, rb)) if x != y)
            problems.append(f"values differ, first at sorted row {bad}: {ra[bad]} vs {rb[bad]}")
    return problems


def spark_types(df) -> dict:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_types(con, sql: str) -> dict:
    rel = con.sql(sql)
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


_EQUIV = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
}


def schema_problems(sdf, con, sql: str) -> list[str]:
    st, dt = spark_types(sdf), duck_types(con, sql)
    out = []
    for name, t in st.items():
        want = _EQUIV.get(t)
        got = dt.get(name)
        if want and got and want != got:
            out.append(f"schema {name}: spark {t} vs duckdb {got}")
    return out
