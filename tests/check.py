"""Run registered queries against their SQL in DuckDB: python tests/check.py [sf] [name...]"""
import math
import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return [cell(x) for x in v]
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([cell(r[i]) for i in order]) for r in rows))


def compare(spark, con, sf_dir, name, query, sql):
    t = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - t
    if sql is None:
        return True, f"{name}: rows only {len(got)} ({spent:.1f}s)"
    t = time.time()
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    types = {c[0]: str(c[1]) for c in rel.description}
    want = rel.fetchall()
    spent2 = time.time() - t
    if sorted(cols) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} vs {sorted(cols)}"
    bad = [c for c, k in df.dtypes if (k == "int" or (k == "bigint") != ("BIGINT" in types[c]) or "HUGE" in types[c] or "DECIMAL" in types[c]
                                       or (k == "double") != ("DOUBLE" in types[c]))]
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        sa, sb = set(a), set(b)
        return False, (f"{name}: rows {len(a)} vs {len(b)}\n   columns {sorted(cols)}\n   spark {[x[:600] for x in a if x not in sb][:3]}"
                       f"\n   duck  {[x[:600] for x in b if x not in sa][:3]}")
    return True, f"{name}: ok {len(a)} rows ({spent:.1f}s, duck {spent2:.1f}s){' TYPES ' + str([(c, dict(df.dtypes)[c], types[c]) for c in bad]) if bad else ''}"


def main():
    import duckdb
    from pyspark.sql import SparkSession
    import __spark_entry__ as e
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    queries, oracles = e.queries(), e.oracle_sql()
    names = sys.argv[2:] or list(queries)
    names = [q for n in names for q in queries if q == n or (n.endswith("*") and q.startswith(n[:-1]))]
    fails = 0
    for name in names:
        try:
            ok, text = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as err:
            ok, text = False, f"{name}: ERROR {str(err)[:1500]}"
        fails += not ok
        if not ok or "-q" not in names:
            print(("" if ok else "FAIL ") + text, flush=True)
    print(f"{len(names) - fails}/{len(names)} ok; missing oracle: {[n for n in queries if n not in oracles]}")


if __name__ == "__main__":
    main()
