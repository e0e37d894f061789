"""Side-by-side run of registered queries on Spark and DuckDB."""

import sys
import time
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    table = df.select(*[f"`{c}`" for c in cols]).toArrow()
    data = [table.column(i).to_pylist() for i in range(len(cols))]
    return cols, sorted((tuple(norm(v) for v in r) for r in zip(*data)), key=repr)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def compare(spark, con, folder, name, function, sql):
    """None when both sides agree, else what differs."""
    cols, rows = spark_rows(function(spark, folder))
    other_cols, other = duck_rows(con, sql)
    if cols != other_cols:
        return f"columns {cols} / {other_cols}"
    if len(rows) != len(other):
        return f"rows {len(rows)} / {len(other)}: {[r for r in rows if r not in set(other)][:2]} / {[r for r in other if r not in set(rows)][:2]}"
    bad = [(a, b) for a, b in zip(rows, other) if a != b]
    return f"{len(bad)} rows differ: {str(bad[:2])[:900]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from grovekit.session import local_session
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = oracle_sql()
    good = 0
    for name, function in queries().items():
        if wanted and not any(name == w or name.startswith(w.rstrip("*")) and w.endswith("*") for w in wanted):
            continue
        t = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, folder, name, function, sqls[name])
            else:
                problem = None if spark_rows(function(spark, folder))[1] else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        good += problem is None
        print(f"{name:28s} {time.time() - t:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("good", good)
