"""Run registered queries on Spark and their SQL on DuckDB and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def oracle(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, name: str, folder: str, queries, twins) -> str:
    """Empty text when equal, else the first difference."""
    df = queries[name](spark, folder)
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    mine = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    if name not in twins:
        return "" if mine else "no rows"
    result = con.execute(twins[name])
    described = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    if sorted(described) != names:
        return f"columns {names} != {sorted(described)}"
    off = {c: (kinds[c], described[c]) for c in names if KINDS.get(kinds[c]) != described[c]}
    if off:
        return f"types {off}"
    order = list(described)
    places = [order.index(c) for c in names]
    other = Counter(tuple(plain(r[i]) for i in places) for r in rows)
    if mine != other:
        extra, lacking = mine - other, other - mine
        return (
            f"rows {sum(mine.values())} vs {sum(other.values())}, only here {sum(extra.values())}"
            f" {list(extra)[:2]}, only there {sum(lacking.values())} {list(lacking)[:2]} of {names}"
        )
    if not mine:
        return "equal but empty"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from gaugeflow.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    queries, twins = entry.queries(), entry.oracle_sql()
    con = oracle(folder)
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder, queries, twins)
        except Exception as error:  # the run goes on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        mark = "ok  " if not problem else "BAD "
        print(f"{mark}{name}{'' if name in twins else ' (rows)'} {time.time() - start:.1f}s {problem}", flush=True)
    print("bad:", bad, "of", len(wanted or queries))
