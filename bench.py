"""Time every query at one scale and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Each query is
planned and run once into a sink that drops the rows; the first query warms the session up
and is timed again at the end of the warm-up.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from eventloom.plans import QUERIES, driver
from eventloom.session import local_session


def seconds_of(function, spark, folder: str) -> float:
    begin = time.perf_counter()
    function(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds_of(QUERIES["daily_stats"], spark, folder)
    timings = {name: seconds_of(function, spark, folder) for name, function in QUERIES.items()}
    events = driver.events(spark, folder).agg(F.count("*")).first()[0]
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": folder.rsplit("sf", 1)[-1],
                "events": events,
                "events_per_second": {
                    name: round(events / timings[name])
                    for name in ("encode_events", "validate_events", "daily_stats", "stream_append_count")
                },
            }
        )
    )


if __name__ == "__main__":
    main()
