"""Run registered queries and print rows / seconds / errors (development aid)."""
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bankflow.plans.queries import QUERIES  # noqa: E402
from bankflow.session import get_spark  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark("local[8]")
    for name in names:
        t = time.time()
        try:
            rows = QUERIES[name](spark, sf).collect()
            print(f"OK   {name:32s} rows={len(rows):7d} {time.time() - t:6.1f}s", flush=True)
        except Exception as e:  # report and continue
            print(f"FAIL {name:32s} {type(e).__name__}: {str(e)[:300]}", flush=True)
            traceback.print_exc(file=sys.stderr)
