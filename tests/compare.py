"""Runs registered queries against their SQL twins in DuckDB: names, types, rows."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
         "DATE": "date"}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def key(row):
    return tuple((v is None, "" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)) for v in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, abs_tol=1e-9)
    return a == b


def differences(df, con, sql):
    """A list of texts, empty when both sides agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    out = [f"type of {n}: {t} != {types[n]}" for n, t in df.dtypes if types[n] != t]
    order = sorted(names)
    pick = [names.index(n) for n in order]
    theirs = sorted((tuple(r[i] for i in pick) for r in result.fetchall()), key=key)
    ours = sorted((tuple(r[n] for n in order) for r in df.collect()), key=key)
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    for a, b in zip(ours, theirs):
        wrong = [(n, x, y) for n, x, y in zip(order, a, b) if not same(x, y)]
        if wrong:
            out.append(f"first differing row: {wrong}"[:1500])
            break
    return out


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from inkwell.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(queries())
    spark = local_session(8)
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            verdict = differences(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = [f"{type(error).__name__}: {error}"[:1800]]
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict or 'ok'}", flush=True)
