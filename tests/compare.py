"""Every catalog query against the same answer in SQL: columns, types by kind, and rows."""

from __future__ import annotations

import glob
import math
import os
from datetime import datetime

import duckdb

KINDS = {
    "TINYINT": "int",
    "SMALLINT": "int",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def tables(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _key(row):
    return tuple((v is not None, str(round(v, 6)) if isinstance(v, float) else str(v)) for v in row)


def difference(df, con, sql):
    """None where both answers are the same, else a line that says how they differ."""
    columns = sorted(df.columns)
    relation = con.sql(sql)
    if columns != sorted(relation.columns):
        return f"columns {columns} vs {sorted(relation.columns)}"
    kinds = dict(df.dtypes)
    expected_kinds = {n: KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    if kinds != expected_kinds:
        return f"types {sorted(kinds.items())} vs {sorted(expected_kinds.items())}"
    found = sorted((tuple(_plain(v) for v in row) for row in df.select(*columns).collect()), key=_key)
    wanted = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    wanted = sorted((tuple(_plain(v) for v in row) for row in wanted), key=_key)
    if len(found) != len(wanted):
        return f"{len(found)} rows vs {len(wanted)}"
    for mine, theirs in zip(found, wanted):
        for a, b in zip(mine, theirs):
            same = math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) and isinstance(b, float) else a == b
            if not same:
                return f"{mine} vs {theirs}"
    return None if found else "no rows"
