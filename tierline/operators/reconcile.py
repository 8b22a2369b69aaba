"""Joins over per-key counts and names.

Inputs have one row per file, month or feed. No side is broadcast by hint: Spark decides from the
measured size.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.expressions import month_index, month_of_index


def unread(landed: DataFrame, ingested: DataFrame) -> DataFrame:
    """Landed rows of names that are not ingested yet. Identity is the name; content is not compared."""
    return landed.join(ingested, "source_file", "left_anti")


def new_files(landed: DataFrame, ingested: DataFrame) -> DataFrame:
    """Landed names not ingested yet, sorted."""
    return unread(landed, ingested).orderBy("source_file")


def reconcile_left(
    left: DataFrame, right: DataFrame, keys: list[str], counts: tuple[str, str]
) -> DataFrame:
    """Keys of `left` whose count differs from `right`'s; missing right means 0.

    Keys only on the right are not reported.
    """
    return _mismatches(left.join(right, keys, "left"), keys, counts)


def reconcile_both(
    left: DataFrame, right: DataFrame, keys: list[str], counts: tuple[str, str]
) -> DataFrame:
    """Keys of either side whose counts differ; missing means 0 on both sides."""
    return _mismatches(left.join(right, keys, "full_outer"), keys, counts)


def reconcile_fixed(
    wanted: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], counts: tuple[str, str]
) -> DataFrame:
    """Only the wanted keys are compared; missing means 0 on both sides."""
    joined = wanted.select(*keys).join(left, keys, "left").join(right, keys, "left")
    return _mismatches(joined, keys, counts)


def _mismatches(joined: DataFrame, keys: list[str], counts: tuple[str, str]) -> DataFrame:
    filled = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts]
    return joined.select(*keys, *filled).where(F.col(counts[0]) != F.col(counts[1]))


def missing_periods(landed: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Months (YYYY-MM) of [start, end] that no landed file covers.

    `landed` has year and month columns. Without `end` the range ends at the latest landed month.
    """
    have = landed.select(month_index(F.col("year"), F.col("month")).alias("index")).distinct()
    last = F.col("latest") if end is None else _index_of(end)
    span = have.agg(F.max("index").alias("latest")).select(
        _index_of(start).alias("first"), last.alias("last")
    )
    # sequence would count down from a start past the end; an empty landing has no latest month
    expected = span.where("first <= last").select(F.explode(F.sequence("first", "last")).alias("index"))
    missing = expected.join(have, "index", "left_anti")
    return missing.select(month_of_index(F.col("index")).alias("period"))


def _index_of(period: str) -> Column:
    year, month = (F.lit(int(part)) for part in period.split("-"))
    return month_index(year, month)
