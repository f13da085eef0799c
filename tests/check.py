"""Command line check: python tests/check.py [folder] [name prefix ...]"""

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, duck

import __spark_entry__ as entry
from lumenframe.session import local_session

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    con = duck(sf)
    oracles = entry.oracle_sql()
    failed = []
    total = 0.0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, n, spent = compare(spark, con, sf, fn, oracles.get(name))
        except Exception as e:
            problem, n, spent = f"{type(e).__name__}: {str(e)[:700]}", 0, 0.0
            if wanted:
                print("".join(traceback.format_exc(limit=-6))[:1500])
        total += spent
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {spent:6.2f}s {n:8d} {name} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"total {total:.1f}s, failed {len(failed)}: {failed}")
