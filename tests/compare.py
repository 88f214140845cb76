"""Run queries in Spark and their oracle SQL in DuckDB and compare all rows."""

import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else round(v, 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def difference(con, df, sql):
    """None when equal, else a short text."""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ: {bad[:3]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from treatflow.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session("8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, build in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(con, build(spark, sf_dir), oracles[name])
            else:
                problem = f"rows only: {build(spark, sf_dir).count()}"
        except Exception as e:
            problem = "FAILED " + str(e)[:1500]
        print(f"{name} {time.time() - start:.1f}s {problem or 'ok'}", flush=True)
