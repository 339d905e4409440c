"""Compare registered queries with their SQL twins: ``check.py [folder] [name-prefix ...]``."""

import sys
import time

from beaconry.plans import REGISTRY
from beaconry.session import get_session
from tests.compare import connect, difference


def main(argv):
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = [n for n in REGISTRY if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = []
    for n in wanted:
        q = REGISTRY[n]
        t = time.time()
        try:
            df = q.run(spark, folder)
            msg = difference(df, con, q.sql) if q.sql else f"no SQL twin, {df.count()} rows"
            ok = msg is None or not q.sql
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        if not ok:
            failed.append(n)
        print(f"{'ok  ' if ok else 'FAIL'} {n} {time.time() - t:.2f}s {msg or ''}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
