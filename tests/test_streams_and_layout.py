"""Streams that take further feeds and stop on a loss, the range layout of silver, SQL over the views."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import X, Y, land, values
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_plans import line, plan

from tierline import Layers, build, conform, ingest
from tierline.plans import questions
from tierline.plans.catalog import create_tables, create_views, described_columns, described_table
from tierline.plans.statements import STATEMENTS, ask
from tierline.schema import GOLD, GOLD_COMMENT
from tierline.sources.versioned import ReconciliationError
from tierline.streaming import hops
from tierline.streaming.hops import conform_batch, stream_feeds

# streams


@pytest.fixture
def landed(layers):
    land(layers, X, "x_2020-01.parquet", [1.0, None])
    ingest(layers, X)
    target = Layers(layers.spark, f"{layers.root}-streamed")
    return layers, target.silver, f"{target.root}/checkpoint"


def held(silver) -> list[tuple]:
    return values(silver.read(), "feed", "month", "amount", "_source_version")


def test_a_feed_joins_without_a_new_target_or_checkpoint(landed):
    layers, silver, checkpoint = landed
    stream_feeds(layers, [X, Y], silver, checkpoint)  # y has not landed
    assert len(held(silver)) == 2
    land(layers, Y, "y_2020-01.parquet", [-1.0])
    land(layers, X, "x_2020-02.parquet", [5.0])
    for feed in (X, Y):
        ingest(layers, feed)
    for _ in range(2):  # the second run finds nothing
        stream_feeds(layers, [X, Y], silver, checkpoint)
    conform(layers, [X, Y])
    columns = ("feed", "month", "amount", "is_amount_valid", "_source_version")
    assert values(silver.read(), *columns) == values(layers.silver.read(), *columns)
    assert [row[0] for row in values(silver.history(), "operation")] == ["stream x 0", "stream x 1", "stream y 0"]


def test_a_loss_stops_the_stream_and_nothing_is_published(landed, monkeypatch):
    layers, silver, checkpoint = landed
    whole = hops.to_silver
    with monkeypatch.context() as patch:
        patch.setattr(hops, "to_silver", lambda rows, feed: whole(rows, feed).where("amount is not null"))
        with pytest.raises(StreamingQueryException, match="2 rows were read, 1 written"):
            stream_feeds(layers, [X], silver, checkpoint)
    assert not silver.exists() and silver.remove_staging() == 0
    stream_feeds(layers, [X], silver, checkpoint)  # the batch is taken again
    assert len(held(silver)) == 2


def test_a_loss_in_a_later_batch_keeps_the_earlier_ones(landed, monkeypatch):
    layers, silver, checkpoint = landed
    for month in (2, 3, 4):
        land(layers, X, f"x_2020-0{month}.parquet", [float(month), -1.0])
        ingest(layers, X)
    whole = hops.to_silver
    with monkeypatch.context() as patch:
        patch.setattr(hops, "to_silver", lambda rows, feed: whole(rows, feed).where("not (month = 3 and amount < 0)"))
        with pytest.raises(StreamingQueryException, match="nothing is published"):
            stream_feeds(layers, [X], silver, checkpoint, max_bytes="1")
    seen = {row[1] for row in held(silver)}
    assert 3 not in seen and 4 not in seen and 1 in seen
    stream_feeds(layers, [X], silver, checkpoint, max_bytes="1")
    assert silver.read().count() == 8


def test_a_batch_published_before_a_crash_is_skipped(landed):
    layers, silver, _ = landed
    batch = layers.bronze("x").read_inserts_since(0)
    conform_batch(silver, X, batch, 7)
    conform_batch(silver, X, batch, 7)
    assert len(held(silver)) == 2 and silver.versions() == [0]


def test_append_compares_with_the_written_footers(layers):
    rows = layers.spark.range(10).selectExpr("id", "concat('f', id % 2) as source_file")
    bronze = layers.bronze("x")
    with pytest.raises(ReconciliationError, match="11 rows were read, 10 written"):
        bronze.append(rows, "copy", expected=lambda: 11)
    assert not bronze.exists()
    assert bronze.append(rows, "copy", expected=lambda: 10).rows == 10
    assert bronze.append(rows.limit(0), "none", expected=lambda: 0) is None
    with pytest.raises(ReconciliationError, match="3 rows were read, 0 written"):
        bronze.append(rows.limit(0), "lost", expected=lambda: 3)


# layout


def months_per_file(silver) -> list[tuple[int, set]]:
    files = Path(silver.path).rglob("feed=*/*.parquet")
    tables = [pq.read_table(file, partitioning=None, columns=["month"]) for file in files]
    return [(len(table), set(table.column("month").to_pylist())) for table in tables]


def test_range_layout_has_even_files_of_few_months_and_splits_a_hot_one(layers):
    spark = layers.spark
    for month in range(1, 7):  # month 3 is hot; every entry is read by several tasks
        rows = spark.range(9000 if month == 3 else 600).selectExpr(
            "id as entity_code", "1D as party_size", "1D as total_amount",
            "timestamp_ntz'2020-01-01 12:00:00' as x_start", "timestamp_ntz'2020-01-01 12:00:00' as x_end",
        )
        rows.repartition(4).write.parquet(f"{layers.landing('x')}/x_2020-{month:02}.parquet")
    ingest(layers, X)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")  # so that a task gets several months
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    plain = BesideBronze(spark, f"{layers.root}-plain", layers.root)
    try:
        (commit,) = conform(layers, [X], file_rows=2000)
        conform(plain, [X])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert commit.rows == 12_000
    ranges, tasks = months_per_file(layers.silver), months_per_file(plain.silver)
    assert len(ranges) == 6 and max(n for n, _ in ranges) < 4000
    assert sum(3 in months for _, months in ranges) >= 4  # the hot month is spread
    spans = sum(len(months) for _, months in ranges)
    assert spans <= 6 + 5 and spans <= sum(len(months) for _, months in tasks)  # one file more at each cut
    columns = ("entity_id", "month", "amount", "_source_version")
    assert values(layers.silver.read(), *columns) == values(plain.silver.read(), *columns)


def test_layout_is_chosen_per_commit(layers):
    land(layers, X, "x_2020-01.parquet", [1.0] * 10)
    ingest(layers, X)
    conform(layers, [X])
    land(layers, X, "x_2020-02.parquet", [1.0] * 10)
    ingest(layers, X)
    conform(layers, [X], file_rows=4)
    assert layers.silver.read().count() == 20 and layers.silver.watermark("x") == 1
    files = layers.silver.read().select("_commit_version", F.col("_metadata.file_path").alias("p")).distinct()
    assert values(files.groupBy("_commit_version").count()) == [(0, 1), (1, 3)]


def test_tasks_of_a_range_layout_follow_the_rows_not_the_files(layers):
    for month in range(1, 4):
        land(layers, X, f"x_2020-0{month}.parquet", [float(month)] * 40)
    ingest(layers, X)
    conform(layers, [X], file_rows=5)
    files = list(Path(layers.silver.path).rglob("feed=*/*.parquet"))
    assert [n for n, _ in months_per_file(layers.silver)] == [5] * 24
    assert len({file.name.split("-")[1] for file in files}) == 1  # part-<task>-...: one task wrote them all
    months = [set(pq.read_table(file, partitioning=None).column("month").to_pylist()) for file in files]
    assert all(len(found) == 1 for found in months)
    assert layers.silver.read().count() == 120


class BesideBronze(Layers):
    def __init__(self, spark, root, bronze_root):
        super().__init__(spark, root)
        object.__setattr__(self, "bronze_root", bronze_root)

    def bronze(self, feed):
        return Layers(self.spark, self.bronze_root).bronze(feed)


# SQL


@pytest.fixture
def built(layers):
    for month in (1, 2):
        land(layers, X, f"x_2020-0{month}.parquet", [1.0, -2.0, None])
    land(layers, Y, "y_2020-01.parquet", [5.25])
    build(layers, [X, Y])
    return layers


def test_statements_equal_the_functions(built):
    create_views(built, [X, Y], prefix="s_")
    gold, frame = "s_gold_activity", built.gold.read()
    for statement, function, parameters in (
        ("average_amount_per_month", questions.average_amount_per_month, {"feed": "x", "year": 2020, "first": 1, "last": 2}),
        ("average_party_per_hour", questions.average_party_per_hour, {"year": 2020, "month": 1}),
        ("revenue_per_feed_and_month", questions.revenue_per_feed_and_month, {"year": 2020, "first": 1, "last": 2}),
        ("volume_per_hour", questions.volume_per_hour, {"year": 2020, "month": 1}),
    ):
        asked = ask(built.spark, statement, gold=gold, **parameters)
        assert values(asked) == values(function(frame, **parameters)) != [], statement
    assert values(ask(built.spark, "rows_since", silver="s_silver_activity", start=0)) == [("x", 0, 6, 4), ("y", 0, 1, 0)]


def test_parameters_are_values_not_text(built):
    create_views(built, [X, Y], prefix="s_")
    asked = ask(built.spark, "average_amount_per_month", gold="s_gold_activity", feed="x' or 'a' = 'a", year=2020, first=1, last=12)
    assert asked.count() == 0 and all("'" not in text for text in STATEMENTS.values())


def test_the_catalog_tells_the_contract_and_prunes(built):
    spark = built.spark
    create_tables(built, [X, Y], prefix="k_")
    told = {row["col_name"]: (row["data_type"], row["comment"]) for row in described_columns(spark, "k_gold.activity").collect()}
    for field in GOLD:
        assert told[field.name] == (field.dataType.simpleString(), field.metadata["comment"])
    assert described_table(spark, "k_gold.activity").first()["comment"] == GOLD_COMMENT
    text = plan(ask(spark, "average_amount_per_month", gold="k_gold.activity", feed="x", year=2020, first=2, last=2))
    (filters,) = line(text, "PartitionFilters")
    assert all(name in filters for name in ("feed", "year", "month"))
    assert line(text, "ReadSchema") == ["struct<amount:decimal(10,2)>"]
