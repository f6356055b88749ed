"""Run every query against its SQL: python tests/check_all.py [folder] [name …]"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.compare import compare, connect  # noqa: E402
from tarmac.plans.oracle import ORACLE  # noqa: E402
from tarmac.plans.queries import QUERIES  # noqa: E402
from tarmac.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    shared = {"spark__checkpoint__dir": tempfile.mkdtemp(), "spark__sql__warehouse__dir": tempfile.mkdtemp()}
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", **shared)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in sys.argv[2:] or list(QUERIES):
        started = time.time()
        try:
            result = compare(QUERIES[name](spark, folder), ORACLE[name], con)
            state = "ok  " if not result["problems"] else "DIFF"
        except Exception as error:  # noqa: BLE001
            result, state = {"rows": -1, "spark": 0, "sql": 0, "problems": [str(error)[:1500]]}, "FAIL"
        failed += state != "ok  "
        print(
            f"{state} {name:24s} rows={result['rows']:7d} total={time.time() - started:6.2f} "
            f"spark={result['spark']:6.2f} sql={result['sql']:6.2f} {result['problems'] or ''}",
            flush=True,
        )
    print("failed:", failed)
    spark.stop()
