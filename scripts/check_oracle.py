"""Run registered queries against their DuckDB oracle, as the correctness gate does.

usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dataloom.plans import REGISTRY  # noqa: E402
from dataloom.plans.oracle import compare, duck  # noqa: E402
from dataloom.session import get_spark  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = get_spark()
    con = duck(sf)
    bad = 0
    for name, e in REGISTRY.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = e.fn(spark, sf)
            if e.sql:
                res = compare(df, e.sql, con)
            else:
                res = {"ok": True, "rows_only": df.count()}
        except Exception as ex:  # report and continue
            res = {"ok": False, "error": f"{type(ex).__name__}: {str(ex)[:600]}", "tb": traceback.format_exc()[-800:]}
        res["sec"] = round(time.time() - t0, 2)
        if not res["ok"]:
            bad += 1
            print("FAIL", name, json.dumps(res, default=str)[:2500], flush=True)
        else:
            print("ok  ", name, res.get("spark_rows", res.get("rows_only")), res["sec"], flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
