"""Column expressions. All are built-in functions, so they stay inside generated code."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Period in a file name, share scale, amount buckets (exclusive upper bounds).
PERIOD_PATTERN = "[0-9]{4}-[0-9]{2}"
HUNDRED = Decimal("100.0")
AMOUNT_BUCKETS = (("0-20", 20), ("20-50", 50), ("50-100", 100))
LAST_BUCKET = "100+"


def file_year(name: Column) -> Column:
    """Year in a file name. A name without YYYY-MM fails the cast under ANSI."""
    return F.substring(_file_period(name), 1, 4).cast("int")


def file_month(name: Column) -> Column:
    """Month in a file name, like file_year."""
    return F.substring(_file_period(name), 6, 2).cast("int")


def _file_period(name: Column) -> Column:
    """First YYYY-MM in a name. Year and month share it, so a row's name is matched once."""
    return F.regexp_extract(name, PERIOD_PATTERN, 0)


def month_index(year: Column, month: Column) -> Column:
    """Running number of a month, so that ranges and steps are integer arithmetic."""
    return year * 12 + month - 1


def month_of_index(index: Column) -> Column:
    """Inverse of month_index, written YYYY-MM."""
    year = F.floor(index / 12).cast("int")
    return F.format_string("%04d-%02d", year, (index % 12 + 1).cast("int"))


def is_valid_amount(raw_amount: Column) -> Column:
    """Whether the uncast amount is a non-negative value; missing counts as not."""
    return F.coalesce(raw_amount >= 0, F.lit(False))


def amount_bucket(amount: Column) -> Column:
    """Label of the amount's bucket. NULL fails every bound and lands in the last one."""
    label = F.when(amount < 0, "negative").when(amount == 0, "zero")
    for name, bound in AMOUNT_BUCKETS:
        label = label.when(amount < bound, name)
    return label.otherwise(LAST_BUCKET)


def null_count(column: str) -> Column:
    """How many rows lack the column. NULL over no rows, unlike count_if."""
    return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0))


def share_of_total(count: str) -> Column:
    """Percentage of a count in the sum of all rows' counts, to one decimal.

    Meant for already aggregated rows: the window is unpartitioned, so its input must be few.
    """
    total = F.sum(count).over(Window.partitionBy())
    return F.round(F.lit(HUNDRED) * F.col(count) / total, 1)


def max_source_version(table: DataFrame) -> DataFrame:
    """One row: the highest `_source_version`, -1 when there are no rows."""
    highest = F.coalesce(F.max("_source_version"), F.lit(-1).cast("bigint"))
    return table.agg(highest.alias("version"))
