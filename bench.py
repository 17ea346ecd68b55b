"""Times the reports on relations landed as Parquet, the form a warehouse holds them in.

Landing (deriving the relations from the given tables) is timed apart.  Every report is run
once to warm up and then ``BENCH_RUNS`` times, every row of its result computed and dropped; the
fastest run counts.  ``BENCH_FOLDER`` is where relations are landed, if not in a temporary folder.  Prints one JSON line.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

from biblioscope import session
from fixtures.report_queries import REPORT_QUERIES
from fixtures.warehouse import land, warehouse


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    with contextlib.ExitStack() as stack:
        folder = os.environ.get("BENCH_FOLDER") or stack.enter_context(tempfile.TemporaryDirectory(prefix="bench-"))
        started = time.perf_counter()
        tables = land(warehouse(spark, sf_dir), f"{folder}/warehouse", files=int(cpus))
        landing = time.perf_counter() - started
        seconds, rows = {}, {}
        for name, query in REPORT_QUERIES.items():
            times = []
            for _ in range(1 + runs):
                started = time.perf_counter()
                query(tables).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - started)
                spark.catalog.clearCache()  # what was kept for the report
            rows[name] = query(tables).count()
            spark.catalog.clearCache()
            seconds[name] = round(min(times[1:]), 3)
            print(f"{name}: {seconds[name]} s, {rows[name]} rows", file=sys.stderr)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the 14 reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "landing_sec": round(landing, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
