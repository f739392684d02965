"""Run every registered query against its oracle: ``python -m checks.run_compare [sf_dir] [name...]``."""

from __future__ import annotations

import json
import sys
import time

from checks.compare import compare, duckdb_connection
from checks.registry import REGISTRY
from tillroll.plans.session import build_session


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = build_session("local[8]")
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in names:
        fn, sql = REGISTRY[name]
        t0 = time.time()
        df = fn(spark, sf_dir)
        if sql is None:
            res = {"ok": True, "spark_rows": df.count(), "oracle": "none"}
        else:
            res = compare(df, con, sql)
        res["sec"] = round(time.time() - t0, 2)
        bad += not res["ok"]
        print(json.dumps({name: res}, default=str), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
