"""Reports over small hand-made gold and silver rows."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import NOON, X, Y, land, values
from pyspark.sql import functions as F

from tierline import GOLD, SILVER, Layers, build
from tierline.functions.expressions import (
    amount_bucket,
    max_source_version,
    month_index,
    month_of_index,
)
from tierline.operators.reconcile import missing_periods
from tierline.plans import exploration, quality, questions


def gold_row(amount, feed="x", year=2020, month=1, hour=0, party=1, entity=1, length=0):
    start = datetime(year, month, 1, hour)
    cents = None if amount is None else Decimal(amount)
    return (entity, party, cents, start, start + timedelta(hours=length), feed, year, month, hour, 0)


@pytest.fixture
def gold(spark):
    return lambda *rows: spark.createDataFrame(list(rows), GOLD)


def test_null_audit_of_no_rows_counts_zero_and_sums_null(gold):
    assert values(quality.null_audit(gold())) == [(0, None, None, None, None)]


def test_null_audit_counts_each_column(gold):
    row = list(gold_row("1"))
    missing = [row[0], None, None, None, None, *row[5:]]
    assert values(quality.null_audit(gold(row, tuple(missing), tuple(row)))) == [(3, 1, 1, 1, 1)]


def test_bucket_bounds_and_null(spark):
    amounts = ["-0.01", "0", "0.01", "19.99", "20", "49.99", "50", "99.99", "100", None]
    df = spark.createDataFrame([(a,) for a in amounts], "a string")
    got = df.select(amount_bucket(F.col("a").cast("decimal(10,2)")))
    assert [row[0] for row in got.collect()] == [
        "negative", "zero", "0-20", "0-20", "20-50", "20-50", "50-100", "50-100", "100+", "100+",
    ]


def test_histogram_is_ordered_by_amount_and_hides_it(gold):
    rows = gold(*[gold_row(a) for a in ("150", "30", "-1", "0", "10", "70", None, "31")])
    histogram = exploration.amount_histogram(rows)
    assert [tuple(row) for row in histogram.collect()] == [
        ("negative", 1), ("zero", 1), ("0-20", 1), ("20-50", 2), ("50-100", 1), ("100+", 2),
    ]


def test_average_amount_keeps_negatives_ignores_null_and_rounds_half_up(gold):
    rows = gold(
        gold_row("0.01"), gold_row("0.00"), gold_row(None),
        gold_row("-0.01", month=2), gold_row("0.00", month=2),
        gold_row("9", month=6), gold_row("9", feed="y"), gold_row("9", year=2021),
    )
    answer = questions.average_amount_per_month(rows, "x", 2020, 1, 5)
    assert [tuple(row) for row in answer.collect()] == [
        (2020, 1, Decimal("0.01")),
        (2020, 2, Decimal("-0.01")),
    ]


def test_average_party_drops_zero_and_unknown(gold):
    parties = [(1, 8), (2, 8), (0, 8), (None, 8), (None, 9), (3, 10)]
    rows = gold(*[gold_row("1", party=party, hour=hour) for party, hour in parties])
    answer = questions.average_party_per_hour(rows, 2020, 1)
    assert [tuple(row) for row in answer.collect()] == [(8, 1.5), (10, 3.0)]


def test_revenue_counts_rows_without_amount_but_does_not_average_them(gold):
    rows = gold(gold_row("10"), gold_row(None), gold_row("-4"), gold_row("1", feed="y", month=2))
    answer = questions.revenue_per_feed_and_month(rows, 2020, 1, 5)
    assert [tuple(row) for row in answer.collect()] == [
        ("x", 2020, 1, 3, Decimal("6.00"), Decimal("3.00")),
        ("y", 2020, 2, 1, Decimal("1.00"), Decimal("1.00")),
    ]


def test_share_is_of_the_filtered_rows(gold):
    rows = gold(*[gold_row("1", hour=h) for h in (1, 1, 2)], *[gold_row("1", month=2)] * 7)
    answer = questions.volume_per_hour(rows, 2020, 1)
    assert [tuple(row) for row in answer.collect()] == [(1, 2, Decimal("66.7")), (2, 1, Decimal("33.3"))]


def test_pivots_show_missing_cells_as_null(gold):
    rows = gold(gold_row("1"), gold_row("2"), gold_row("5", feed="y", month=2))
    assert values(questions.trips_pivot(rows, ["x", "y", "z"], 2020)) == [
        (1, 2, None, None),
        (2, None, 1, None),
    ]
    assert values(questions.revenue_pivot(rows, ["x", "y"], 2020, 1, 2)) == [
        (1, Decimal("3.00"), None),
        (2, None, Decimal("5.00")),
    ]


def test_profiles(gold):
    rows = gold(
        gold_row("1", party=None, entity=7, length=-1), gold_row("1", entity=7), gold_row("1", feed="y", hour=5)
    )
    assert values(exploration.month_coverage(rows)) == [("x", 2020, 1, 2), ("y", 2020, 1, 1)]
    assert [tuple(row) for row in exploration.share_per_feed(rows).collect()] == [
        ("x", 2, Decimal("66.7")),
        ("y", 1, Decimal("33.3")),
    ]
    assert [tuple(row) for row in exploration.entity_distribution(rows).collect()] == [(7, 2), (1, 1)]
    assert [tuple(row) for row in exploration.party_distribution(rows).collect()] == [(None, 1), (1, 2)]
    assert values(exploration.start_range(rows)) == [
        ("x", datetime(2020, 1, 1), datetime(2020, 1, 1)),
        ("y", datetime(2020, 1, 1, 5), datetime(2020, 1, 1, 5)),
    ]
    assert values(quality.bad_intervals(rows)) == [(1,)]


def test_unknown_times_are_not_bad_intervals(gold):
    row = list(gold_row("1"))
    assert values(quality.bad_intervals(gold(tuple([*row[:4], None, *row[5:]])))) == [(0,)]


def test_validity_split(spark):
    rows = [(1, 1, Decimal(a), NOON, NOON, "x", Decimal(a) >= 0, 2020, 1, 0) for a in ("-3", "-1", "2")]
    assert values(quality.validity_split(spark.createDataFrame(rows, SILVER))) == [
        (False, 2, Decimal("-3.00"), Decimal("-1.00")),
        (True, 1, Decimal("2.00"), Decimal("2.00")),
    ]


def test_layer_and_environment_reports(layers):
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])
    land(layers, X, "x_2020-02.parquet", [1.0])
    build(layers, [X])
    assert [tuple(r) for r in quality.layer_reconciliation(layers, [X, Y]).collect()] == [
        ("bronze", "x", 3), ("gold", "x", 3), ("silver", "x", 3), ("bronze", "y", 0),
    ]
    assert values(exploration.rows_per_layer(layers, "x")) == [("bronze", 3), ("gold", 3), ("silver", 3)]
    assert values(exploration.files_and_rows(layers, [X, Y])) == [("x", 2, 3), ("y", 0, 0)]
    empty = Layers(layers.spark, f"{layers.root}-other")
    assert values(exploration.compare_environments({"dev": empty, "prod": layers}, "x")) == [
        ("dev", 0, 0),
        ("prod", 2, 3),
    ]


@pytest.mark.parametrize(
    ("months", "start", "end", "expected"),
    [
        ([1, 2, 4], "2020-01", None, ["2020-03"]),
        ([1, 2, 4], "2019-12", "2020-05", ["2019-12", "2020-03", "2020-05"]),
        ([1], "2020-02", None, []),
        ([], "2020-01", None, []),
        ([], "2020-01", "2020-02", ["2020-01", "2020-02"]),
        ([1], "2020-02", "2020-01", []),
    ],
)
def test_missing_periods(spark, months, start, end, expected):
    landed = spark.createDataFrame([(2020, month) for month in months], "year int, month int")
    assert [period for (period,) in values(missing_periods(landed, start, end))] == expected


def test_month_index_round_trip(spark):
    df = spark.createDataFrame([(1999, 12), (2000, 1), (2024, 10)], "y int, m int")
    index = month_index(F.col("y"), F.col("m"))
    assert values(df.select(index, month_of_index(index))) == [
        (1999 * 12 + 11, "1999-12"),
        (2000 * 12, "2000-01"),
        (2024 * 12 + 9, "2024-10"),
    ]


def test_watermark_of_no_rows(spark, gold):
    assert values(max_source_version(gold())) == [(-1,)]
