"""Run registered queries against their SQL oracles: ``python tests/compare.py [sf_dir] [names...]``."""

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def oracle_connection(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def run_spark(spark, query, sf):
    df = query(spark, sf)
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def run_oracle(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return rows_of(columns, result.fetchall())


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ctxloom.runtime import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf)
    oracle = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        t0 = time.time()
        try:
            got = run_spark(spark, query, sf)
        except Exception as e:  # noqa: BLE001
            print(f"{name:24} SPARK ERROR {str(e)[:1500]}", flush=True)
            failed.append(name)
            continue
        t1 = time.time()
        if name not in oracle:
            print(f"{name:24} no SQL rows={len(got[1])} spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            want = run_oracle(con, oracle[name])
        except Exception as e:  # noqa: BLE001
            print(f"{name:24} ORACLE ERROR {str(e)[:800]}", flush=True)
            failed.append(name)
            continue
        t2 = time.time()
        ok = got == want
        print(f"{name:24} {'ok ' if ok else 'BAD'} rows={len(got[1])}/{len(want[1])} spark={t1 - t0:.1f}s oracle={t2 - t1:.1f}s", flush=True)
        if not ok:
            failed.append(name)
            print("   columns", got[0], want[0])
            a, b = set(map(repr, got[1])), set(map(repr, want[1]))
            print("   only spark ", list(a - b)[:3])
            print("   only oracle", list(b - a)[:3])
    print("failed:", failed)
