"""Physical plans: what is pruned, what is not read, where nothing is shuffled."""

import contextlib
import io
import re

import pytest
from conftest import X, Y, land
from pyspark.sql import functions as F

from tierline import Layers, build
from tierline.operators.conform import to_gold, to_silver
from tierline.plans import exploration, questions, verify
from tierline.sources.landing import landed_parts, landing_counts, read_new_files, scanned_counts


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def line(text: str, label: str) -> list[str]:
    return [part.split(": ", 1)[1] for part in text.splitlines() if part.startswith(f"{label}: ")]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    layers = Layers(spark, str(tmp_path_factory.mktemp("plans")))
    for month in (1, 2):
        for feed in (X, Y):
            land(layers, feed, f"{feed.name}_2020-0{month}.parquet", [1.0, 2.0])
        build(layers, [X, Y])
    return layers


def test_question_reads_only_its_period_feed_and_columns(built):
    text = plan(questions.average_amount_per_month(built.gold.read(), "x", 2020, 1, 1))
    (filters,) = line(text, "PartitionFilters")
    assert all(name in filters for name in ("feed", "year", "month"))
    assert line(text, "ReadSchema") == ["struct<amount:decimal(10,2)>"]


def test_row_filter_is_pushed_to_the_files(built):
    text = plan(questions.average_party_per_hour(built.gold.read(), 2020, 1))
    assert "GreaterThan(party_size,0)" in line(text, "PushedFilters")[0]
    assert line(text, "ReadSchema") == ["struct<party_size:int,start_hour:int>"]


def test_pruning_leaves_one_directory(built):
    scope = questions.in_months(built.gold.read(), 2020, 1, 1).where(F.col("feed") == "x")
    files = scope.select(F.col("_metadata.file_path").alias("path")).distinct().collect()
    assert len(files) == 1 and "/feed=x/year=2020/month=1/" in files[0]["path"]


def test_hops_do_not_shuffle_and_list_only_the_delta(built):
    bronze = built.bronze("x").read_inserts_since(1, 1)
    silver = built.silver.read_inserts_since(2, 3)
    for text in (plan(to_silver(bronze, X)), plan(to_gold(silver))):
        assert "Exchange" not in text and "Python" not in text
        (location,) = line(text, "Location")
        assert "_commit_version=0" not in location and "_commit_version=" in location


def test_ingest_reads_each_schema_in_one_scan_without_a_shuffle(built):
    names = ["x_2020-01.parquet", "x_2020-02.parquet"]
    text = plan(read_new_files(built.spark, built.landing("x"), names))
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "Exchange" not in text


def test_table_counts_come_from_footers(built):
    for counts in (
        verify.file_counts(built, [X]),
        verify.bronze_totals(built, [X]),
        verify.feed_totals(built.silver),
        verify.feed_totals(built.gold),
        exploration.files_and_rows(built, [X]),
    ):
        assert set(line(plan(counts), "PushedAggregation")) == {"[COUNT(*)]"}


def scanned(layers, feed):
    return scanned_counts(layers.spark, layers.landing(feed), landed_parts(layers.spark, layers.landing(feed)))


def test_other_counts_read_no_column(built):
    assert set(line(plan(exploration.month_coverage(built.gold.read())), "ReadSchema")) == {"struct<>"}
    assert "ReadSchema: struct<>" in plan(scanned(built, "x"))


def test_landed_rows_are_counted_by_number_and_named_per_file(built):
    text = plan(scanned(built, "x"))
    assert "Scan parquet" in text and "Scan binaryFile" in text
    keys = [part for part in line(text, "Keys [1]") if "file#" in part]
    assert keys and all(re.search(r"file#\d+L", part) for part in keys)  # a bigint, not a path


def test_landed_counts_read_footers_and_no_row(built):
    counts = landing_counts(built.spark, {"x": built.landing("x"), "y": built.landing("y")})
    text = plan(counts)
    assert "Scan parquet" not in text and "Scan binaryFile" in text and "content" not in text
    assert text.count("Exchange hashpartitioning") <= 2  # named in the tree and in its details: one for all feeds


def test_hot_month_is_written_by_many_tasks(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    rows = spark.range(4000).selectExpr(
        "id as entity_code", "1D as party_size", "1D as total_amount",
        "timestamp_ntz'2020-01-01 12:00:00' as x_start", "timestamp_ntz'2020-01-01 12:00:00' as x_end",
    )
    rows.repartition(8).write.parquet(f"{layers.landing('x')}/x_2020-01.parquet")
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        gold = build(layers, [X])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    files = gold.select("year", "month", F.col("_metadata.file_path").alias("path")).distinct()
    assert gold.count() == 4000 and files.select("year", "month").distinct().count() == 1
    assert files.count() >= 8


def test_counts_are_combined_before_the_shuffle(built):
    text = plan(exploration.entity_distribution(built.gold.read()))
    assert "partial_count" in text and text.index("partial_count") < text.index("hashpartitioning")
