"""Run registered queries in Spark and DuckDB and report agreement (manual tool)."""
import sys
import time

sys.path.insert(0, "/root/repo")
from ledgerlake.session import build_session  # noqa: E402
from tests.compare import compare, duck  # noqa: E402
import __spark_entry__ as entry  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session()
con = duck(sf)
qs, oracle = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or qs:
    t = time.time()
    df = qs[name](spark, sf)
    if name not in oracle:
        n = df.count()
        print(f"{name:28s} rows={n} (no oracle) {time.time()-t:.1f}s", flush=True)
        continue
    r = compare(df, con, oracle[name])
    ok = r["values_match"] and r["spark_rows"] == r["duck_rows"]
    bad += not ok
    print(f"{name:28s} {'OK ' if ok else 'BAD'} {r['spark_rows']}/{r['duck_rows']} {time.time()-t:.1f}s",
          flush=True)
    if not ok:
        print("   ", {k: v for k, v in r.items() if k not in ('spark_rows', 'duck_rows')})
print("mismatches:", bad)
