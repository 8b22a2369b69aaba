"""Time the pipeline and the headline questions; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Landing files are derived first, untimed. Then, on a fresh root: a full build with all gates, a
rerun with nothing new, and a run with one new month of one feed. Questions are the median of five
runs after one warm-up, written to the noop sink.
"""

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tierline import Layers, build, get_session
from tierline.plans import exploration, quality, questions
from tierline.sources.files import child_names, move
from workload.feeds import FEEDS, land, scratch_root, write_entries
from workload.queries import FEED, FIRST, HOUR_MONTH, LAST, YEAR, streamed

RUNS = 5
HELD_BACK = ("b", "b_2001-08.parquet")  # lands after the full build


def timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median_time(query: Callable[[], DataFrame]) -> float:
    def run() -> None:
        query().write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(timed(run) for _ in range(RUNS))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="20g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_root(spark)
    write_entries(spark, sf_dir, f"{root}/written")
    layers = Layers(spark, f"{root}/prod")
    land(spark, f"{root}/written", layers)
    feed, name = HELD_BACK
    if name not in child_names(spark, layers.landing(feed)):
        raise SystemExit(f"{sf_dir} has no {name} to hold back")
    move(spark, f"{layers.landing(feed)}/{name}", f"{root}/held/{name}")

    times = {"full_build": timed(lambda: build(layers, FEEDS))}
    times["noop_rerun"] = timed(lambda: build(layers, FEEDS))
    move(spark, f"{root}/held/{name}", f"{layers.landing(feed)}/{name}")
    times["one_file_increment"] = timed(lambda: build(layers, FEEDS))
    times["stream_both_hops"] = timed(lambda: streamed(layers))

    gold, silver = layers.gold.read(), layers.silver.read()
    reads: dict[str, Callable[[], DataFrame]] = {
        "q1_avg_amount": lambda: questions.average_amount_per_month(gold, FEED, YEAR, FIRST, LAST),
        "q2_avg_party": lambda: questions.average_party_per_hour(gold, YEAR, HOUR_MONTH),
        "q3_revenue": lambda: questions.revenue_per_feed_and_month(gold, YEAR, FIRST, LAST),
        "q4_peak_hours": lambda: questions.volume_per_hour(gold, YEAR, HOUR_MONTH),
        "amount_histogram": lambda: exploration.amount_histogram(gold),
        "month_coverage": lambda: exploration.month_coverage(gold),
        "share_per_feed": lambda: exploration.share_per_feed(gold),
        "null_audit": lambda: quality.null_audit(gold),
        "validity_split": lambda: quality.validity_split(silver),
        "layer_reconciliation": lambda: quality.layer_reconciliation(layers, FEEDS),
    }
    times |= {label: median_time(query) for label, query in reads.items()}
    result = {
        "metric": "sum of build, rerun, increment, stream and question times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {label: round(seconds, 3) for label, seconds in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
