"""Compare catalogue queries with their SQL in DuckDB: ``python tests/oracle.py FOLDER [query ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalog import ORACLE, QUERIES  # noqa: E402
from catalog.core import TABLES  # noqa: E402


def plain(value):
    """One form for the values both engines return. NaN stays apart from NULL: the library emits none."""
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def expected(con, name):
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return columns, cursor.fetchall(), types


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, con, folder, name, df=None):
    """None when the results agree, else what differs."""
    df = QUERIES[name](spark, folder) if df is None else df
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    want_columns, want, types = expected(con, name)
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} instead of {sorted(want_columns)}"
    a, b = as_rows(got_columns, got), as_rows(want_columns, want)
    if a != b:
        extra, lacking = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{len(got)} rows instead of {len(want)}; {sorted(want_columns)}\n  extra {extra}\n  lacking {lacking}"
    kinds = dict(df.dtypes)
    for c, t in types.items():
        text = t.lower()
        spark_type = kinds[c]
        pairs = {
            "bigint": ("bigint", "number"), "integer": ("int", "number"), "double": ("double", "number"),
            "varchar": ("string",), "date": ("date",), "timestamp": ("timestamp_ntz",), "boolean": ("boolean",),
        }
        if text in pairs and spark_type not in pairs[text]:
            return f"type of {c}: {spark_type} against {t}"
        if text not in pairs:
            return f"type of {c}: {spark_type} against {t}"
    return None if got else "no rows"


def main(folder, names):
    from tidemerge.session import local_session

    spark, con = local_session("8"), connect(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLE:
                problem = difference(spark, con, folder, name)
            else:
                problem = None if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as e:  # report and go on
            problem = str(e)[:1500]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
