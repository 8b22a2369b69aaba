"""Data-quality statements over silver and gold."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.expressions import null_count
from tierline.operators.aggregates import count_rows
from tierline.plans.layers import Layers
from tierline.plans.verify import at_once, bronze_totals, feed_totals
from tierline.schema import FeedSpec


def null_audit(gold: DataFrame) -> DataFrame:
    """Rows, and how many lack each consumption column. Only party_size is expected to."""
    return gold.agg(
        F.count(F.lit(1)).alias("rows"),
        null_count("amount").alias("null_amount"),
        null_count("start_ts").alias("null_start"),
        null_count("end_ts").alias("null_end"),
        null_count("party_size").alias("null_party"),
    )


def validity_split(silver: DataFrame) -> DataFrame:
    """Rows and amount range on either side of the validity flag."""
    return silver.groupBy("is_amount_valid").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def bad_intervals(gold: DataFrame) -> DataFrame:
    """How many rows end before they start; unknown times do not count."""
    return count_rows(gold.where(F.col("end_ts") < F.col("start_ts")), alias="bad_intervals")


def layer_reconciliation(layers: Layers, feeds: Iterable[FeedSpec]) -> DataFrame:
    """Rows per feed in each layer, side by side. Conformation is 1:1, so they must agree."""
    counts = {
        "bronze": lambda: bronze_totals(layers, feeds),
        "silver": lambda: feed_totals(layers.silver),
        "gold": lambda: feed_totals(layers.gold),
    }
    frames = at_once(lambda make: make(), counts.values())
    labelled = [df.select(F.lit(name).alias("layer"), "feed", "rows") for name, df in zip(counts, frames, strict=True)]
    return reduce(DataFrame.union, labelled).orderBy("feed", "layer")
