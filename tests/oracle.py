"""Run registered queries against DuckDB on the same files and compare cell by cell.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def kind(t: str) -> str:
    t = t.lower()
    return {"varchar": "string", "float": "real", "integer": "int"}.get(t, t)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[str, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = f"{time.time() - t0:5.1f}s {len(got):>7} rows"
    if sql is None:
        return ("rows" if got else "EMPTY"), took
    rel = con.sql(sql)
    want = rel.fetchall()
    cols = list(rel.columns)
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", f"{took} spark={df.columns} sql={cols}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if len(a) != len(b):
        return "COUNT", f"{took} spark={len(a)} sql={len(b)} {str(a[:2])[:300]} {str(b[:2])[:300]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return "VALUES", f"{took} {len(bad)} differ, e.g.\n   spark {str(bad[0][0])[:700]}\n   sql   {str(bad[0][1])[:700]}"
    st = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    dt = {c: kind(str(x)) for c, x in zip(cols, rel.types)}
    off = {c: (st[c], dt[c]) for c in st if st[c] != dt[c]}
    return ("types" if off else "ok"), f"{took} {off or ''}"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main(argv):
    import __spark_entry__ as e
    from tabprep.session import get_session

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("oracle", 8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    qs, sql = e.queries(), e.oracle_sql()
    names = [n for n in qs if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    tally: dict[str, int] = {}
    for n in names:
        try:
            status, note = compare(spark, con, n, qs[n], sql.get(n), sf_dir)
        except Exception as ex:  # report and go on with the next query
            status, note = "ERROR", str(ex).split("\n")[0][:400]
        tally[status] = tally.get(status, 0) + 1
        print(f"{status:8} {n:26} {note}", flush=True)
    print(tally)


if __name__ == "__main__":
    main(sys.argv[1:])
