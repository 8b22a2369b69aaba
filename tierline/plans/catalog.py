"""Names for SQL users: catalog tables with their documentation, or temporary views."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans.layers import Layers
from tierline.schema import (
    GOLD_COMMENT,
    LAYER_COMMENTS,
    SILVER_COMMENT,
    SOURCE_FILE_COMMENT,
    FeedSpec,
    bronze_comment,
)
from tierline.sources.versioned import VERSION_FIELD, VersionedTable

TABLE = "activity"


def quoted(text: str) -> str:
    """A text as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_tables(layers: Layers, feeds: Iterable[FeedSpec], prefix: str = "") -> list[str]:
    """Create the schemas and tables that do not exist yet, and (re)apply all comments.

    Tables are external: the files are the layers' own, and dropping a table leaves them. `prefix`
    tells environments apart in one catalog. A feed that never landed has no bronze table. Returns
    the table names. Call it again after a run to show new partitions and columns.
    """
    spark = layers.spark
    for layer, comment in LAYER_COMMENTS.items():
        place = quoted(f"{layers.root}/catalog/{layer}")  # nothing is stored there: the tables are external
        spark.sql(f"create schema if not exists `{prefix}{layer}` location {place}")
        spark.sql(f"comment on schema `{prefix}{layer}` is {quoted(comment)}")
    contracts = {
        f"`{prefix}silver`.`{TABLE}`": (layers.silver, SILVER_COMMENT),
        f"`{prefix}gold`.`{TABLE}`": (layers.gold, GOLD_COMMENT),
    }
    raw = {
        f"`{prefix}bronze`.`{feed.name}`": (layers.bronze(feed.name), bronze_comment(feed.name))
        for feed in feeds
        if layers.bronze(feed.name).exists()
    }
    for name, (table, comment) in {**raw, **contracts}.items():
        _create(spark, name, table, comment)
    return [*raw, *contracts]


def _create(spark: SparkSession, name: str, table: VersionedTable, comment: str) -> None:
    columns = T.StructType([_documented(field) for field in (*table.schema(), VERSION_FIELD)])
    if spark.catalog.tableExists(name) and set(spark.table(name).columns) != set(columns.names):
        spark.sql(f"drop table {name}")  # a new raw column: only the catalog entry is replaced
    keys = (VERSION_FIELD.name, *table.partitions)
    spark.sql(
        f"create table if not exists {name} ({columns.toDDL()}) using parquet "
        f"partitioned by ({', '.join(keys)}) location '{table.path}'"
    )
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    spark.sql(f"comment on table {name} is {quoted(comment)}")
    for field in columns:
        text = field.metadata.get("comment")
        if text and field.name not in keys:  # a partition column keeps its comment from creation
            spark.sql(f"alter table {name} alter column `{field.name}` comment {quoted(text)}")


def described_columns(spark: SparkSession, name: str) -> DataFrame:
    """A registered table's columns as the catalog has them: col_name, data_type, comment."""
    described = spark.sql(f"describe table {name}")  # partition columns are listed twice
    return described.where(~F.col("col_name").startswith("#") & (F.col("col_name") != "")).distinct()


def described_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table's own comment."""
    described = spark.sql(f"describe table extended {name}").where("col_name = 'Comment'")
    return described.select(F.col("data_type").alias("comment"))


def _documented(field: T.StructField) -> T.StructField:
    if field.name != "source_file":
        return field
    return T.StructField(field.name, field.dataType, True, {"comment": SOURCE_FILE_COMMENT})


def create_views(layers: Layers, feeds: Iterable[FeedSpec], prefix: str = "") -> list[str]:
    """Temporary views `bronze_<feed>`, `silver_activity` and `gold_activity` of the current rows."""
    frames = {
        f"{prefix}bronze_{feed.name}": layers.bronze(feed.name)
        for feed in feeds
        if layers.bronze(feed.name).exists()
    }
    frames |= {f"{prefix}silver_{TABLE}": layers.silver, f"{prefix}gold_{TABLE}": layers.gold}
    for name, table in frames.items():
        table.read().createOrReplaceTempView(name)
    return list(frames)
