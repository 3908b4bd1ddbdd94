"""Run a registered query and its SQL on the same tables and compare the results."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _rows(table: pa.Table):
    names = sorted(table.column_names)
    cols = [table[n].to_pylist() for n in names]
    key = lambda r: tuple((v is None, str(type(v)), v if not isinstance(v, float) else v) for v in r)
    return names, sorted(zip(*cols), key=lambda r: repr(key(r)))


def kinds(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    out = []
    if kinds(spark_table) != kinds(sql_table):
        a, b = kinds(spark_table), kinds(sql_table)
        out.append(f"types: {[(k, a.get(k), b.get(k)) for k in sorted({*a, *b}) if a.get(k) != b.get(k)]}")
    names_a, a = _rows(spark_table)
    names_b, b = _rows(sql_table)
    if names_a != names_b:
        return out
    if len(a) != len(b):
        out.append(f"rows: {len(a)} and {len(b)}")
    # -0.0 and 0.0 count as equal
    norm = lambda r: tuple(v + 0.0 if isinstance(v, float) else v for v in r)
    left, right = {}, {}
    for r in a:
        left[norm(r)] = left.get(norm(r), 0) + 1
    for r in b:
        right[norm(r)] = right.get(norm(r), 0) + 1
    if left != right:
        only_a = [r for r in left if left[r] != right.get(r)][:3]
        only_b = [r for r in right if right[r] != left.get(r)][:3]
        n = sum(1 for r in left if left[r] != right.get(r))
        out.append(f"values ({names_a}): {n} of {len(a)} differ, spark {only_a}, sql {only_b}")
    return out


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from sigspark.session import get_spark

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = get_spark("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    con.execute("SET TimeZone='UTC'")
    sql = oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = fn(spark, sf).toArrow()
            took = time.time() - start
            start = time.time()
            diff = differences(got, con.execute(sql[name]).to_arrow_table()) if name in sql else ["no sql"]
            print(f"{name:24s} {took:6.2f}s sql {time.time() - start:5.2f}s {got.num_rows:7d} rows {'ok' if not diff else diff}", flush=True)
            bad += bool(diff) and diff != ["no sql"]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:24s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("bad:", bad)
