"""The gates: each passes on whole layers and raises on lost, doubled and unexpected rows."""

import pytest
from conftest import X, Y, land, values
from pyspark.sql import functions as F

from tierline import build
from tierline.plans.verify import (
    ReconciliationError,
    bronze_mismatches,
    gold_mismatches,
    silver_mismatches,
    verify_bronze,
    verify_gold,
    verify_silver,
)


@pytest.fixture
def built(layers):
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])
    land(layers, Y, "y_2020-01.parquet", [3.0])
    build(layers, [X, Y])
    return layers


def extra_rows(table, feed: str, as_feed: str | None = None) -> None:
    """Append rows the table already has, optionally under another feed's name."""
    rows = table.read().where(f"feed = '{feed}'").drop("_commit_version")
    if as_feed is not None:
        rows = rows.withColumn("feed", F.lit(as_feed))
    table.append(rows, "tamper")


def test_whole_layers_pass(built):
    verify_bronze(built, [X, Y])
    verify_silver(built, [X, Y])
    verify_gold(built)


def test_unread_landed_file_is_reported(built):
    land(built, Y, "y_2020-02.parquet", [1.0] * 3)
    assert values(bronze_mismatches(built, [X, Y])) == [("y", "y_2020-02.parquet", 3, 0)]
    with pytest.raises(ReconciliationError, match="y_2020-02"):
        verify_bronze(built, [X, Y])


def test_doubled_bronze_rows_are_reported(built):
    bronze = built.bronze("x")
    bronze.append(bronze.read().drop("_commit_version"), "tamper")
    assert values(bronze_mismatches(built, [X, Y])) == [("x", "x_2020-01.parquet", 2, 4)]
    assert values(silver_mismatches(built, [X, Y])) == [("x", 4, 2)]


def test_bronze_only_files_are_not_reported(built):
    rows = built.bronze("x").read().drop("_commit_version")
    renamed = rows.withColumn("source_file", F.lit("gone_2019-01.parquet"))
    built.bronze("x").append(renamed, "file later removed from landing")
    assert values(bronze_mismatches(built, [X, Y])) == []


def test_doubled_silver_rows_fail_both_later_gates(built):
    extra_rows(built.silver, "x")
    assert values(silver_mismatches(built, [X, Y])) == [("x", 2, 4)]
    assert values(gold_mismatches(built)) == [("x", 4, 2)]
    with pytest.raises(ReconciliationError):
        verify_silver(built, [X, Y])


def test_unknown_feed_in_silver_is_ignored_but_not_in_gold(built):
    extra_rows(built.silver, "x", as_feed="z")
    assert values(silver_mismatches(built, [X, Y])) == []
    assert values(gold_mismatches(built)) == [("z", 2, 0)]
    with pytest.raises(ReconciliationError, match="'feed': 'z'"):
        verify_gold(built)


def test_extra_feed_in_gold_is_reported(built):
    extra_rows(built.gold, "y", as_feed="z")
    assert values(gold_mismatches(built)) == [("z", 0, 1)]


def test_configured_feed_without_rows_counts_zero_on_both_sides(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    assert values(silver_mismatches(layers, [X, Y])) == []


def test_failed_gate_stops_the_build(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])  # changed under the same name
    land(layers, X, "x_2020-02.parquet", [1.0])
    with pytest.raises(ReconciliationError):
        build(layers, [X])
    assert layers.bronze("x").versions() == [0, 1]
    assert layers.silver.versions() == [0]
