"""Run a registered query and its SQL side by side and compare the values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).toArrow().to_pylist()
    return names, Counter(tuple(plain(r[n]) for n in names) for r in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def difference(spark_result, duck_result) -> str | None:
    """What differs, or None when columns and every value agree."""
    (names, ours), (theirs_names, theirs) = spark_result, duck_result
    if names != theirs_names:
        return f"columns: {sorted(set(names) ^ set(theirs_names))}"
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    key = lambda row: tuple((v is None, str(type(v)), str(v)) for v in row)
    a = sorted(only_ours.elements(), key=key)[:1]
    b = sorted(only_theirs.elements(), key=key)[:1]
    shown = ""
    if a and b:
        shown = str([(n, x, y) for n, x, y in zip(names, a[0], b[0]) if x != y][:6])
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows, "
        f"{sum(only_ours.values())}/{sum(only_theirs.values())} differ {shown}"
    )


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from tests.session import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sql, failed = make_session(8), connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted or name not in sql:
            continue
        try:
            start = time.time()
            ours = spark_rows(run(spark, sf_dir))
            middle = time.time()
            problem = difference(ours, duck_rows(con, sql[name]))
            print(f"{'FAIL' if problem else 'ok  '} {name} {sum(ours[1].values())} rows "
                  f"spark {middle - start:.1f}s duck {time.time() - middle:.1f}s {problem or ''}", flush=True)
        except Exception as error:
            problem = str(error)[:1500]
            print(f"FAIL {name}: {problem}", flush=True)
        failed += problem is not None
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
