"""Row-preserving projections between the layers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.expressions import file_month, file_year, is_valid_amount
from tierline.schema import GOLD, SILVER, FeedSpec


def conform_to_table(df: DataFrame, table: T.StructType | None) -> DataFrame:
    """Give an incoming batch the types the table already has.

    Columns in both are cast to the table's type (raising if a value does not fit), columns only
    in the batch are kept and extend the table, columns only in the table are filled with NULL.
    Without a table the batch passes unchanged and so fixes the types.
    """
    if table is None:
        return df
    present = set(df.columns)
    return df.withColumns(
        {
            field.name: (F.col(field.name) if field.name in present else F.lit(None)).cast(
                field.dataType
            )
            for field in table
        }
    )


def to_silver(changes: DataFrame, feed: FeedSpec) -> DataFrame:
    """Conform bronze rows of one feed: canonical names and types, validity flag, file period.

    `changes` has the raw columns named by `feed`, plus source_file and _source_version. Every row
    is kept. The flag looks at the raw amount, before the cast rounds it.
    """
    raw_amount = F.col(feed.amount_col)
    name = F.col("source_file")
    canonical = changes.select(
        F.col(feed.entity_col).cast("int").alias("entity_id"),
        F.col(feed.party_col).cast("int").alias("party_size"),
        raw_amount.cast("decimal(10,2)").alias("amount"),
        F.col(feed.start_col).cast("timestamp").alias("start_ts"),
        F.col(feed.end_col).cast("timestamp").alias("end_ts"),
        F.lit(feed.name).alias("feed"),
        is_valid_amount(raw_amount).alias("is_amount_valid"),
        file_year(name).alias("year"),
        file_month(name).alias("month"),
        F.col("_source_version"),
    )
    return to_contract(canonical, SILVER)


def to_gold(changes: DataFrame) -> DataFrame:
    """Silver rows as served: the flag dropped, the hour of day added."""
    return to_contract(changes.withColumn("start_hour", F.hour("start_ts")), GOLD)


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, matched by name; a missing or other-typed one raises."""
    found = {field.name: field.dataType for field in df.schema}
    wrong = [f.name for f in contract if found.get(f.name) != f.dataType]
    if wrong:
        raise TypeError(f"columns missing or of another type than the contract's: {wrong}")
    return df.to(contract)


def pick_column(df: DataFrame, column: str, alias: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select a column whose name is a query parameter, under a fixed alias, next to `keep`."""
    kept = "".join(f"`{name}`, " for name in keep)
    return df.sparkSession.sql(
        f"select {kept}identifier(:column) as `{alias}` from {{batch}}",
        args={"column": column},
        batch=df,
    )
