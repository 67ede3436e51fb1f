"""Time every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The library derived from the tables is stored before the clock starts for the
queries that read it, as a library in use is; deriving it is timed as well, by
the queries of the preparation steps and as ``library_setup``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import tables
from checks.queries import REGISTRY
from specloom.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "specloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # As many shuffle partitions as cores: nothing to coalesce.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(build) -> float:
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    timed(lambda: tables.table(spark, sf_dir, "orders"))
    seconds = {}
    started = time.perf_counter()
    for stored in (tables.raw, tables.spectra, tables.documents, tables.embeddings, tables.requests):
        stored(spark, sf_dir)
    seconds["library_setup"] = round(time.perf_counter() - started, 3)
    for key in sys.argv[1:] or REGISTRY:
        seconds[key] = timed(lambda: REGISTRY[key](spark, sf_dir))
        print(key, seconds[key], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cores": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
