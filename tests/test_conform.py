"""Bronze to silver to gold: values, watermarks, contracts."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import NOON, X, Y, land, values
from pyspark.sql import functions as F

from tierline import GOLD, SILVER, build, conform, ingest, publish
from tierline.operators.conform import pick_column, to_contract, to_gold, to_silver
from tierline.sources.versioned import VersionedTable

NAN = float("nan")


def silver_of(layers, amounts, **columns):
    land(layers, X, "x_2020-01.parquet", amounts, **columns)
    ingest(layers, X)
    return to_silver(layers.bronze("x").read_inserts_since(0), X)


def test_flag_looks_at_the_raw_amount(layers):
    rows = silver_of(layers, [-0.001, 0.0, None, NAN, -5.0, 12.345])
    assert values(rows, "entity_id", "is_amount_valid", "amount") == [
        (0, False, Decimal("0.00")),
        (1, True, Decimal("0.00")),
        (2, False, None),
        (3, True, None),
        (4, False, Decimal("-5.00")),
        (5, True, Decimal("12.35")),
    ]


def test_amount_beyond_the_decimal_raises(layers):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        silver_of(layers, [1e9]).collect()


def test_party_size_is_truncated(layers):
    rows = silver_of(layers, [1.0] * 3, parties=[1.9, None, 0.0])
    assert values(rows, "entity_id", "party_size") == [(0, 1), (1, None), (2, 0)]


def test_party_size_not_a_number_raises(layers):
    with pytest.raises(Exception, match="CAST_OVERFLOW|CAST_INVALID_INPUT"):
        silver_of(layers, [1.0], parties=[NAN]).collect()


def test_entity_beyond_int_raises(layers):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        silver_of(layers, [1.0], entities=[2**40]).collect()


def test_file_name_without_a_period_fails_the_hop(layers):
    land(layers, X, "x_latest.parquet", [1.0])
    ingest(layers, X)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(layers, [X])
    assert not layers.silver.exists()


def test_period_is_the_files_and_hour_the_rows(layers):
    land(layers, X, "x_2023-07.parquet", [1.0])  # its row is from 2020-01
    rows = build(layers, [X])
    assert values(rows, "year", "month", "start_hour", "start_ts") == [(2023, 7, 12, NOON)]


def test_hops_keep_contract_columns_and_types(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    for table, contract in ((layers.silver, SILVER), (layers.gold, GOLD)):
        fields = {f.name: f.dataType for f in table.read().drop("_commit_version").schema}
        assert fields == {f.name: f.dataType for f in contract}
        assert values(table.read(), "feed", "year", "month") == [("x", 2020, 1)]


def test_contract_refuses_missing_and_mistyped_columns(spark):
    with pytest.raises(TypeError, match="entity_id"):
        to_contract(spark.range(1), SILVER)
    rows = spark.createDataFrame([], GOLD).withColumn("year", F.lit("2020"))
    with pytest.raises(TypeError, match=r"\['year'\]"):
        to_contract(rows, GOLD)


def test_each_feed_has_its_own_watermark_and_gold_one(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    land(layers, Y, "y_2020-01.parquet", [1.0])
    build(layers, [X, Y])
    land(layers, Y, "y_2020-02.parquet", [2.0])
    build(layers, [X, Y])
    silver, gold = layers.silver, layers.gold
    assert (silver.watermark("x"), silver.watermark("y"), silver.watermark("z")) == (0, 1, -1)
    assert gold.watermark() == 2
    assert values(silver.read(), "_commit_version", "feed", "_source_version") == [
        (0, "x", 0),
        (1, "y", 0),
        (2, "y", 1),
    ]
    assert values(gold.read(), "_commit_version", "feed", "_source_version") == [
        (0, "x", 0),
        (0, "y", 1),
        (1, "y", 2),
    ]


def test_hops_catch_up_on_several_versions_at_once(layers):
    for month in (1, 2, 3):
        land(layers, X, f"x_2020-0{month}.parquet", [float(month)])
        ingest(layers, X)
    assert [commit.rows for commit in conform(layers, [X])] == [3]
    assert values(layers.silver.read(), "month", "_source_version") == [(1, 0), (2, 1), (3, 2)]
    assert layers.silver.watermark("x") == 2
    assert publish(layers).rows == 3


def test_rerun_commits_nothing_in_any_layer(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    build(layers, [X])
    assert conform(layers, [X]) == [] and publish(layers) is None
    tables = (layers.bronze("x"), layers.silver, layers.gold)
    assert [table.versions() for table in tables] == [[0], [0], [0]]


def test_feed_that_never_landed_is_skipped(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    assert values(build(layers, [X, Y]), "feed") == [("x",)]


def test_feed_names_are_not_confused_by_prefixes_or_escapes(layers):
    from tierline import FeedSpec

    odd = [FeedSpec(name, "x_start", "x_end") for name in ("x", "x y", "x=y", "1")]
    for feed in odd:
        land(layers, feed, "f_2020-01.parquet", [1.0])
    assert values(build(layers, odd), "feed") == [("1",), ("x",), ("x y",), ("x=y",)]
    assert [layers.silver.watermark(feed.name) for feed in odd] == [0, 0, 0, 0]
    assert conform(layers, odd) == []


def test_read_inserts_since_is_inclusive_and_bounded(layers):
    table = VersionedTable(layers.spark, f"{layers.root}/t", ("source_file",))
    for n in range(4):
        rows = layers.spark.range(1).selectExpr(
            f"{n} as n", "99L as _source_version", f"'f{n}.parquet' as source_file"
        )
        table.append(rows, "test")
    read = table.read_inserts_since(1, 2)
    assert values(read, "n", "_source_version") == [(1, 1), (2, 2)]
    assert "_commit_version" not in read.columns
    assert values(table.read_inserts_since(3), "n") == [(3,)]
    assert values(table.read_inserts_since(4), "n") == []


def test_pick_column_by_parameter(spark):
    df = spark.createDataFrame([(1, 2)], "left int, right int")
    assert values(pick_column(df, "right", "picked", keep=("left",))) == [(1, 2)]


def test_gold_replaces_the_source_version(spark):
    row = (1, 1, Decimal("1.00"), NOON, NOON, "x", True, 2020, 1, 7)
    gold = to_gold(spark.createDataFrame([row], SILVER))
    assert gold.columns == GOLD.names
    assert values(gold, "start_hour", "_source_version") == [(12, 7)]
    assert datetime(2020, 1, 1, 12) == NOON
