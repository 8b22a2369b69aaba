"""Row-count reconciliation after every hop.

The `*_mismatches` functions return the disagreeing keys as a frame; the `verify_*` gates raise on
any. Counts of the tables are by all their partition columns, in a session where Spark takes them from
Parquet footers. Landed files have no partition columns; tasks read their footers, a row per file.
"""

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.reconcile import reconcile_both, reconcile_fixed, reconcile_left
from tierline.plans.layers import Layers
from tierline.schema import FeedSpec
from tierline.session import counting_session
from tierline.sources.landing import landing_counts, stack_feeds
from tierline.sources.versioned import ReconciliationError, VersionedTable


Item = TypeVar("Item")


def table_counts(table: VersionedTable) -> DataFrame:
    """Rows per combination of partition columns, from footers."""
    return table.counts(counting_session(table.spark))


def at_once(make: Callable[[Item], DataFrame], items: Iterable[Item]) -> list[DataFrame]:
    """`make` of every item, in threads: planning a count lists a tree of directories, which takes most of its time."""
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(make, items))


def bronze_counts(layers: Layers, feeds: Iterable[FeedSpec]) -> dict[str, DataFrame]:
    """The counts of each feed's bronze table."""
    feeds = list(feeds)
    counts = at_once(lambda feed: table_counts(layers.bronze(feed.name)), feeds)
    return {feed.name: df for feed, df in zip(feeds, counts, strict=True)}


def file_counts(layers: Layers, feeds: Iterable[FeedSpec]) -> DataFrame:
    """Rows per source file in the feeds' bronze tables."""
    counts = {name: df.select("source_file", "rows") for name, df in bronze_counts(layers, feeds).items()}
    return stack_feeds(counts).groupBy("feed", "source_file").agg(F.sum("rows").alias("bronze_rows"))


def bronze_totals(layers: Layers, feeds: Iterable[FeedSpec], alias: str = "rows") -> DataFrame:
    """Rows per feed over the bronze tables; 0 for a feed that never landed."""
    counts = {name: df.select(F.col("rows").alias("n")) for name, df in bronze_counts(layers, feeds).items()}
    floor = feed_frame(layers.spark, counts).withColumn("n", F.lit(0).cast("bigint"))
    return stack_feeds(counts).union(floor).groupBy("feed").agg(F.sum("n").alias(alias))


def feed_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """A local one-column frame of feed names."""
    return spark.createDataFrame(pa.table({"feed": pa.array(list(names), pa.string())}))


def feed_totals(table: VersionedTable, alias: str = "rows") -> DataFrame:
    """Rows per feed in silver or gold."""
    return table_counts(table).groupBy("feed").agg(F.sum("rows").alias(alias))


def bronze_mismatches(
    layers: Layers, feeds: Iterable[FeedSpec], listed: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Landed files whose rows are not all in bronze. Bronze-only files are not looked at.

    `listed` has the landed files to check by feed, if they were listed before.
    """
    feeds = list(feeds)
    places = {feed.name: layers.landing(feed.name) for feed in feeds}
    landing = landing_counts(layers.spark, places, listed)
    bronze = file_counts(layers, feeds)
    return reconcile_left(landing, bronze, ["feed", "source_file"], ("landing_rows", "bronze_rows"))


def silver_mismatches(layers: Layers, feeds: Iterable[FeedSpec]) -> DataFrame:
    """Configured feeds whose rows differ between bronze and silver."""
    feeds = list(feeds)
    keys = feed_frame(layers.spark, [feed.name for feed in feeds])
    bronze = bronze_totals(layers, feeds, "bronze_rows")
    silver = feed_totals(layers.silver, "silver_rows")
    return reconcile_fixed(keys, bronze, silver, ["feed"], ("bronze_rows", "silver_rows"))


def gold_mismatches(layers: Layers) -> DataFrame:
    """Feeds on either side whose rows differ between silver and gold."""
    sides = ((layers.silver, "silver_rows"), (layers.gold, "gold_rows"))
    silver, gold = at_once(lambda side: feed_totals(*side), sides)
    return reconcile_both(silver, gold, ["feed"], ("silver_rows", "gold_rows"))


def verify_bronze(
    layers: Layers, feeds: Iterable[FeedSpec], listed: Mapping[str, DataFrame] | None = None
) -> None:
    _require_none(bronze_mismatches(layers, feeds, listed), "landed files and bronze")


def verify_silver(layers: Layers, feeds: Iterable[FeedSpec]) -> None:
    _require_none(silver_mismatches(layers, feeds), "bronze and silver")


def verify_gold(layers: Layers) -> None:
    _require_none(gold_mismatches(layers), "silver and gold")


def _require_none(mismatches: DataFrame, sides: str) -> None:
    # at most one row per landed file or feed, and normally none
    rows = [row.asDict() for row in sorted(mismatches.collect())]
    if rows:
        raise ReconciliationError(f"row counts of {sides} differ in {len(rows)} case(s): {rows}")
