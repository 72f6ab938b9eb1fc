"""Run registered queries against their SQL twins: python tests/check_queries.py [sf] [key ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_mod  # noqa: E402
from letterloom.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402


def main(sf="0.01", *keys):
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), duck(sf_dir)
    queries, oracles = entry_mod.queries(), entry_mod.oracle_sql()
    failed = []
    for key in keys or queries:
        start, timing = time.time(), {}
        try:
            df = queries[key](spark, sf_dir)
            if key in oracles:
                problem = compare(df, con, oracles[key], timing)
                n = df.count() if problem is None and keys else ""
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", ""
            if keys:
                traceback.print_exc()
        kind = "H" if key in oracles else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {key:28s} {time.time() - start - timing.get('sql', 0):6.1f}s sql {timing.get('sql', 0):5.1f}s {n} {problem or ''}", flush=True)
        if problem:
            failed.append(key)
    print("failed:", failed)


if __name__ == "__main__":
    main(*sys.argv[1:])
