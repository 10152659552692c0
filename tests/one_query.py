"""python tests/one_query.py NAME...: registered queries against their SQL, by hand."""

import os
import sys
import tempfile
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry  # noqa: E402
from compare import oracle_connection, oracle_side, spark_side  # noqa: E402

from starmart.session import create_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

if __name__ == "__main__":
    conf = {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = create_session("one-query", master="local[8]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    oracle = oracle_connection(SF_DIR)
    for name in sys.argv[1:]:
        start = time.perf_counter()
        types, rows = spark_side(entry.queries()[name](spark, SF_DIR))
        seconds = time.perf_counter() - start
        sql = entry.oracle_sql().get(name)
        want_types, want = oracle_side(oracle, sql) if sql else (types, rows)
        print(name, len(rows), "rows", f"{seconds:.1f} s", "same" if (types, rows) == (want_types, want) else "DIFFERS")
        if (types, rows) != (want_types, want):
            print(types, want_types, sep="\n")
            print([r for r in rows if r not in want][:5], [r for r in want if r not in rows][:5], sep="\n")
