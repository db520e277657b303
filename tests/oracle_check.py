"""Compare registered queries with their DuckDB oracles.

    python tests/oracle_check.py 0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[bool, str]:
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    left, right = rows_of(df.columns, ours), rows_of(names, theirs)
    if left == right:
        types = {type(v).__name__ for row in list(left)[:50] for v in row}
        types2 = {type(v).__name__ for row in list(right)[:50] for v in row}
        return types == types2, f"{len(ours)} rows" + ("" if types == types2 else f" TYPES {types} {types2}")
    extra, missing = left - right, right - left
    return False, (
        f"{len(ours)} vs {len(theirs)} rows; {sum(extra.values())} differ {sorted(df.columns)}\n"
        f"   ours   {sorted(map(str, extra))[:3]}\n   oracle {sorted(map(str, missing))[:3]}"
    )


def main() -> int:
    import __spark_entry__ as contract
    from tollgate.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{df.count()} rows (no oracle)"
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
