"""python tests/oracle.py SF_DIR [NAME...]: registered queries against their SQL in DuckDB."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(d):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(d).glob("*.parquet"):
        src = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"create view {p.stem} as select * from read_parquet('{src}')")
    return con


def rows_of(table):
    cols = sorted(table.column_names)
    data = [[None if isinstance(v, float) and math.isnan(v) else v for v in table.column(c).to_pylist()] for c in cols]
    return cols, sorted((tuple(r) for r in zip(*data, strict=True)), key=str)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))
    return a == b


def compare(spark, con, d, name, query, sql):
    t = time.time()
    got = query(spark, d).toArrow()
    took = time.time() - t
    if sql is None:
        return f"rows only: {got.num_rows}", took
    gc, gr = rows_of(got)
    ec, er = rows_of(con.sql(sql).to_arrow_table())
    if gc != ec:
        return f"COLUMNS {gc} {ec}", took
    bad = [(x, y) for x, y in zip(gr, er, strict=False) if not all(map(same, x, y))]
    if len(gr) != len(er) or bad:
        return f"DIFFERENT rows {len(gr)} {len(er)}, first {bad[:2]}", took
    return f"ok {len(gr)}", took


if __name__ == "__main__":
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    d, names = sys.argv[1], sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(d), e.oracle_sql()
    for n, q in e.queries().items():
        if not names or any(n.startswith(x) for x in names):
            try:
                what, took = compare(spark, con, d, n, q, sqls.get(n))
            except Exception as x:  # noqa: BLE001
                what, took = f"ERROR {type(x).__name__}: {str(x)[:1500]}", 0
            print(f"{n}: {what} ({took:.1f} s)", flush=True)
