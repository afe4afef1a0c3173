"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the driver tables and ``BENCH_CPUS`` the number of local threads. Each query is
run once to warm up and then ``BENCH_RUNS`` times; the median counts. A run covers building the plan, every job the query
starts on the way and computing all columns of all rows (they go to the ``noop`` sink).
"""

from __future__ import annotations

import functools
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surestar.plans import curate  # noqa: E402
from surestar.queries import ALL  # noqa: E402
from surestar.queries.standins import parent, raw  # noqa: E402
from surestar.session import get_session  # noqa: E402
from surestar.sources.feeds import read_csv  # noqa: E402

HEADLINES = (
    "canonical_text", "title_junk_clean", "lenient_number", "dedupe_keep_last", "dedupe_mark_last", "ri_null_tolerant",
    "agg_sum_left", "any_flag", "dense_keys", "dense_keys_by_hash", "sk_lookup_default", "sk_lookup_composite",
    "scd1_state", "scd2_state", "curate_clients", "curate_policies", "curate_claims", "curate_coverages", "fact_policy",
    "fact_claim", "loss_ratio_by_plan_year", "curate_payments", "dq_report", "csv_claims",
)


def csv_claims(spark, folder):
    """Claims as a delimited file, read and curated: the way real feeds take. The file is written once, outside the time."""
    known = [parent(spark, folder, name) for name in ("known_policies", "known_clients", "known_adjusters", "known_items")]
    return curate.claims(read_csv(spark, _csv(spark, folder)), *known)


@functools.cache
def _csv(spark, folder) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="bench-"), "claims")
    raw(spark, folder, "claims").drop("_ordinal").write.option("header", True).csv(path)
    return path


RUN = {**{name: query.run for name, query in ALL.items()}, "csv_claims": csv_claims}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "20g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names.split(",") if names else HEADLINES:
        times = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            RUN[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries (median of warm runs)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
