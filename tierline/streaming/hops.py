"""The two stateless hops as Structured Streaming queries.

A stream tracks the files it has read in its checkpoint, so it needs no watermark. Its target is
written by this stream alone: micro-batch N becomes version N, and a batch replayed after a crash
finds its version there and is skipped, which makes each hop exactly-once.
"""

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierline.operators.conform import to_gold, to_silver
from tierline.plans.layers import Layers
from tierline.schema import FeedSpec
from tierline.sources.versioned import VERSION_COLUMN, VERSION_FIELD, VersionedTable


ANY_AGE = "365000d"  # a thousand years


def stream_inserts(table: VersionedTable, max_bytes: str | None = None) -> DataFrame:
    """Streaming counterpart of read_inserts_since: every row once, tagged with its version.

    `max_bytes` (e.g. "1t") bounds a micro-batch; without it all waiting files form one.
    """
    schema = table.schema()
    if schema is None:
        raise ValueError(f"nothing committed yet: {table.path}")
    reader = table.spark.readStream.schema(T.StructType([*schema.fields, VERSION_FIELD]))
    # files are told apart by the checkpoint; by default older ones than a week would be passed over
    reader = reader.option("maxFileAge", ANY_AGE)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    rows = reader.parquet(table.path)
    return rows.drop("_source_version").withColumnRenamed(VERSION_COLUMN, "_source_version")


def append_batch(target: VersionedTable, operation: str, batch: DataFrame, batch_id: int) -> None:
    """Commit micro-batch `batch_id` as that version, unless it already is one."""
    if batch_id not in target.versions():
        target.append(batch, operation, version=batch_id)


def stream_conform(
    layers: Layers,
    feeds: Iterable[FeedSpec],
    target: VersionedTable,
    checkpoint: str,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Conform everything new in the feeds' bronze tables into `target`, then stop.

    All feeds run as one query, because a target has one writer. Adding a feed changes the query,
    so it needs a new target and checkpoint.
    """
    conformed = [
        to_silver(stream_inserts(layers.bronze(feed.name), max_bytes), feed) for feed in feeds
    ]
    return _start(reduce(DataFrame.unionByName, conformed), target, "stream conform", checkpoint)


def stream_feeds(
    layers: Layers,
    feeds: Iterable[FeedSpec],
    target: VersionedTable,
    checkpoint: str,
    max_bytes: str | None = None,
) -> None:
    """Conform everything new in the feeds' bronze tables into `target`, a stream and a checkpoint per feed.

    A feed can join at any run: it gets a checkpoint of its own below `checkpoint`, and the target and the other
    feeds' checkpoints stay. Feeds run one after another, as a target has one writer. Every micro-batch is
    reconciled before the next: the rows that the stream read must be those that the footers of the written files
    tell, or the batch isn't published and the stream stops. A batch that was published before a crash is known by
    its commit's name and skipped. Feeds that never landed are skipped.
    """
    for feed in feeds:
        bronze = layers.bronze(feed.name)
        if not bronze.exists():
            continue
        query = _start_with(
            stream_inserts(bronze, max_bytes),
            lambda batch, number, feed=feed: conform_batch(target, feed, batch, number),
            f"{checkpoint}/{feed.name}",
        )
        query.awaitTermination()


def conform_batch(target: VersionedTable, feed: FeedSpec, batch: DataFrame, batch_id: int) -> None:
    """Commit a micro-batch of a feed's bronze rows once, if all of its rows arrive."""
    operation = f"stream {feed.name} {batch_id}"
    if target.has_operation(operation):
        return
    read = Observation()
    counted = batch.observe(read, F.count(F.lit(1)).alias("rows"))
    target.append(to_silver(counted, feed), operation, expected=lambda: read.get["rows"])


def stream_publish(
    silver: VersionedTable, target: VersionedTable, checkpoint: str, max_bytes: str | None = None
) -> StreamingQuery:
    """Publish everything new in a silver table into `target`, then stop."""
    return _start(to_gold(stream_inserts(silver, max_bytes)), target, "stream publish", checkpoint)


def _start(
    rows: DataFrame, target: VersionedTable, operation: str, checkpoint: str
) -> StreamingQuery:
    return _start_with(rows, lambda batch, number: append_batch(target, operation, batch, number), checkpoint)


def _start_with(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
