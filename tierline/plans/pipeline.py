"""The incremental hops: landing to bronze, bronze to silver, silver to gold.

Every hop is a map-only Spark job over what its source gained since the last run. Running any of
them again with nothing new commits nothing.
"""

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from tierline.operators.conform import conform_to_table, to_gold, to_silver
from tierline.operators.reconcile import unread
from tierline.plans.catalog import create_tables
from tierline.plans.layers import Layers
from tierline.plans.verify import verify_bronze, verify_gold, verify_silver
from tierline.schema import FeedSpec
from tierline.sources.landing import landed_parts, read_parts
from tierline.sources.versioned import Commit, VersionedTable


def ingested_files(bronze: VersionedTable) -> DataFrame:
    """Names of the files bronze holds rows of; none before its first commit.

    Bronze is partitioned by source_file, so a listing tells it without a scan.
    """
    return bronze.listed_partitions(bronze.partitions[0])


def ingest(layers: Layers, feed: FeedSpec, listed: DataFrame | None = None) -> Commit | None:
    """Append every landed file not yet in the feed's bronze table, as one commit.

    `listed` are the landed files (`landed_parts`), if they were listed before. Landed and ingested names meet
    in Spark; the driver gets the names that are to be read. Files without rows are not read, so a batch of
    nothing else writes nothing.
    """
    landing, bronze = layers.landing(feed.name), layers.bronze(feed.name)
    if listed is None:
        listed = landed_parts(layers.spark, landing)
    batch = read_parts(layers.spark, landing, unread(listed, ingested_files(bronze)))
    if batch is None:
        return None
    return bronze.append(conform_to_table(batch, bronze.schema()), f"ingest {feed.name}")


def ingest_all(
    layers: Layers, feeds: Iterable[FeedSpec], listed: Mapping[str, DataFrame] | None = None
) -> list[Commit]:
    """Ingest every feed. Their tables are independent, so one feed's jobs fill the slots that
    another's listing, schema reading and last tasks leave idle."""
    feeds = list(feeds)
    with ThreadPoolExecutor(max(1, len(feeds))) as pool:
        commits = pool.map(lambda feed: ingest(layers, feed, (listed or {}).get(feed.name)), feeds)
        return [commit for commit in commits if commit is not None]


def conform(layers: Layers, feeds: Iterable[FeedSpec], file_rows: int | None = None) -> list[Commit]:
    """Append each feed's new bronze versions to silver, one commit per feed.

    Feeds are separate tables with their own version counters, so each has its own watermark.
    A feed that never landed is skipped. With `file_rows`, these commits are laid out in ranges of period,
    in even files of about so many rows, at the cost of a shuffle; a hot month gets several files.
    """
    silver = layers.silver
    commits = []
    for feed in feeds:
        bronze = layers.bronze(feed.name)
        watermark, ceiling = silver.watermark(feed.name), bronze.last_version()
        if watermark >= ceiling:
            continue
        changes = bronze.read_inserts_since(watermark + 1, ceiling)
        files = None
        if file_rows is not None:
            files = max(1, -(-bronze.recorded_rows(watermark + 1, ceiling) // file_rows))
        commits.append(silver.append(to_silver(changes, feed), f"conform {feed.name}", files=files, file_rows=file_rows))
    return [commit for commit in commits if commit is not None]


def publish(layers: Layers) -> Commit | None:
    """Append silver's new versions to gold. One source, hence one watermark."""
    silver, gold = layers.silver, layers.gold
    watermark, ceiling = gold.watermark(), silver.last_version()
    if watermark >= ceiling:
        return None
    changes = silver.read_inserts_since(watermark + 1, ceiling)
    return gold.append(to_gold(changes), "publish")


def build(
    layers: Layers,
    feeds: Iterable[FeedSpec],
    report: list[Commit] | None = None,
    document: str | None = None,
) -> DataFrame:
    """Run every hop, each followed by its check, which stops the run on a mismatch.

    Landing directories are listed once, so files that land meanwhile wait for the next run. `report`
    is filled with the run's commits. With `document`, a prefix, the catalog's tables and comments are
    brought up to date at the end. Returns the gold rows.
    """
    feeds = list(feeds)
    report = [] if report is None else report
    listed = {feed.name: landed_parts(layers.spark, layers.landing(feed.name)) for feed in feeds}
    report += ingest_all(layers, feeds, listed)
    verify_bronze(layers, feeds, listed)
    report += conform(layers, feeds)
    verify_silver(layers, feeds)
    published = publish(layers)
    report += [] if published is None else [published]
    verify_gold(layers)
    if document is not None:
        create_tables(layers, feeds, document)
    return layers.gold.read()
