"""Compare every registered query with its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import compare, duck_connection  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as entry
    from tessera.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        df = fn(spark, sf_dir)
        if name not in sqls:
            print(name, "rows", df.count(), "(no oracle)")
            continue
        res = compare(df, sqls[name], con)
        ok = res["values_match"] and res["spark_rows"] == res["oracle_rows"] and not res["type_mismatch"]
        bad += not ok
        print(("OK  " if ok else "FAIL"), name, f"{time.time() - t:.1f}s", json.dumps(res, default=str))
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
