"""Run registered queries and their SQL side by side and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(spark, con, name, run, sql, sf_dir, limit=3):
    """Empty when names, types and all rows agree."""
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    out = []
    for a, b in zip(_rows(df.columns, got), _rows(names, want)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            bad = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if not _same(x, y)]
            out.append(str(bad[:4]))
    return [f"{len(out)} of {len(got)} rows differ", *out[:limit]] if out else []


def main():
    import __spark_entry__ as entry
    from tallyspark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(spark, con, name, run, sql[name], sf_dir)
            else:
                n = len(run(spark, sf_dir).collect())
                found = [] if n else ["no rows"]
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in sql else ' (rows only)'}")
        for line in found:
            print("     ", line[:900])
        sys.stdout.flush()
    print("failed:", bad)


if __name__ == "__main__":
    main()
