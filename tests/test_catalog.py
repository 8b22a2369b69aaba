"""Catalog tables and views over the layers."""

from conftest import X, Y, land, values

from tierline import build
from tierline.plans.catalog import create_tables, create_views


def test_tables_are_documented_idempotent_and_show_new_rows(layers):
    spark = layers.spark
    land(layers, X, "x_2020-01.parquet", [1.0, -2.0])
    build(layers, [X, Y])
    names = create_tables(layers, [X, Y], prefix="t_")
    assert names == ["`t_bronze`.`x`", "`t_silver`.`activity`", "`t_gold`.`activity`"]
    question = "select feed, sum(amount) as total from t_gold.activity where year = 2020 group by feed"
    assert [float(row["total"]) for row in spark.sql(question).collect()] == [-1.0]
    described = {row["col_name"]: row["comment"] for row in spark.sql("describe t_gold.activity").collect()}
    assert described["amount"].startswith("Money of the row") and described["feed"]
    raw = {row["col_name"]: row["comment"] for row in spark.sql("describe t_bronze.x").collect()}
    assert raw["source_file"].startswith("Landed entry")

    import pyarrow as pa

    land(layers, X, "x_2020-02.parquet", [4.0], fee=pa.array([0.5]))
    build(layers, [X, Y])
    create_tables(layers, [X, Y], prefix="t_")
    assert [float(row["total"]) for row in spark.sql(question).collect()] == [3.0]
    assert values(spark.table("t_bronze.x"), "fee") == [(None,), (None,), (0.5,)]
    assert spark.table("t_silver.activity").count() == 3


def test_views(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X, Y])
    names = create_views(layers, [X, Y], prefix="v_")
    assert names == ["v_bronze_x", "v_silver_activity", "v_gold_activity"]
    assert layers.spark.sql("select count(*) as n from v_silver_activity").first()["n"] == 1
