"""Run registered queries against their DuckDB oracles (local check).

usage: python tools/check_oracle.py [sf_dir] [key ...]
"""
import json
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

from runlens.plans.catalog import ORACLE, QUERIES  # noqa: E402
from runlens.plans.compare import compare, duckdb_conn  # noqa: E402
from runlens.plans.oracle_views import with_views  # noqa: E402
from runlens.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:] or sorted(QUERIES)
spark = local_session(8)
con = duckdb_conn(sf)
bad = 0
for k in keys:
    t = time.time()
    try:
        df = QUERIES[k](spark, sf)
        if k in ORACLE:
            r = compare(df, con, with_views(ORACLE[k]))
        else:
            r = {"rows_spark": df.count(), "ok": None}
    except Exception as e:  # noqa: BLE001
        r = {"ok": False, "error": repr(e)[:600]}
    r["sec"] = round(time.time() - t, 2)
    if r.get("ok") is False:
        bad += 1
    print(k, json.dumps(r, default=str)[:1500], flush=True)
print("FAILED", bad, "of", len(keys))
