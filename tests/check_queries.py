"""Compare every registered query with its SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import differences, duck, local_session  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(sql)
    spark, con, bad = local_session(), duck(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            problem = differences(queries[name](spark, sf_dir), con, sql[name])
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'DIFF' if problem else 'ok  '} {name:28s} {time.time() - began:6.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
