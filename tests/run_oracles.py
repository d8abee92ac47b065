"""Run every registered query against its DuckDB oracle and print a report.

usage: python tests/run_oracles.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.harness import compare, duck_connect  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    import __spark_entry__ as E
    from caseflow.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in os_:
                r = compare(df, con, os_[name])
                ok = r["hash_match"] and r["schema_match"]
            else:
                r = {"spark_rows": df.count(), "oracle": None}
                ok = True
        except Exception as e:  # report and continue
            r = {"error": repr(e)[:600]}
            ok = False
        bad += not ok
        print(("OK  " if ok else "BAD ") + name, f"{time.time()-t:.1f}s", json.dumps(r, default=str)[:900],
              flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
