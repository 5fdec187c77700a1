"""Compare queries with their SQL on DuckDB: ``python tests/oracle.py [names]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
            labels conversations""".split()


def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def family(v):
    if v is None or v != v:
        return None
    return v


def canon(v):
    if v is None:
        return "∅"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, float):
        return "∅" if v != v else f"f{v!r}"
    return f"{type(v).__name__}:{v}"


def rows_of(pdf):
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for row in pdf.itertuples(index=False, name=None):
        out.append("\x1f".join(canon(v) for v in row))
    return sorted(out)


def compare(spark, con, sf, name, fn, sql):
    df = fn(spark, sf)
    got = df.toArrow()
    want = con.execute(sql).to_arrow_table()
    names_g, names_w = sorted(got.column_names), sorted(want.column_names)
    if names_g != names_w:
        return f"columns {names_g} vs {names_w}"

    def rows(t):
        cols = [t.column(c).to_pylist() for c in sorted(t.column_names)]
        return sorted("\x1f".join(canon(v) for v in r) for r in zip(*cols))

    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"values differ {len([1 for x, y in zip(a, b) if x != y])}: {names_g} {diff}"
    return None


def main(names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, queries, oracle, bad = duck(sf), entry.queries(), entry.oracle_sql(), []
    for name in names or queries:
        t0 = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, sf, name, queries[name], oracle[name])
            else:
                problem = None if queries[name](spark, sf).count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.1f}s {problem or ''}"[:1200], flush=True)
        if problem:
            bad.append(name)
    print(len(bad), "failed", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
