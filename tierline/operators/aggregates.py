"""Grouped summaries with any grouping keys.

Groups are few (feeds, months, hours, buckets) and rows many, so partial aggregation does the work
before the shuffle, however skewed the keys are.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.expressions import share_of_total


def count_rows(df: DataFrame, *keys: str, alias: str = "rows") -> DataFrame:
    """Rows per key; without keys, one row with the total (0 when empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def rounded_mean(df: DataFrame, column: str, *keys: str, alias: str) -> DataFrame:
    """Mean per key to two decimals; NULLs do not count, negatives do."""
    return df.groupBy(*keys).agg(F.round(F.avg(column), 2).alias(alias))


def count_with_share(df: DataFrame, *keys: str, alias: str = "rows", share: str = "pct") -> DataFrame:
    """Rows per key and their percentage of all rows of `df`, after whatever filter it has."""
    return count_rows(df, *keys, alias=alias).withColumn(share, share_of_total(alias))


def value_range(df: DataFrame, column: str, *keys: str, first: str, last: str) -> DataFrame:
    """Smallest and largest value per key."""
    return df.groupBy(*keys).agg(F.min(column).alias(first), F.max(column).alias(last))


def pivot_by_feed(df: DataFrame, feeds: list[str], *keys: str, value) -> DataFrame:
    """One column per feed holding `value`; a missing cell is NULL.

    The feeds are given, so no extra pass is needed to find them.
    """
    return df.groupBy(*keys).pivot("feed", feeds).agg(value)
