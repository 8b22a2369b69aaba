"""Feed descriptions and the typed contracts of the silver and gold tables."""

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeedSpec:
    """One source feed and the (lowercased) raw columns its canonical columns come from."""

    name: str
    start_col: str
    end_col: str
    entity_col: str = "entity_code"
    party_col: str = "party_size"
    amount_col: str = "total_amount"


def _field(name: str, data_type: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, data_type, True, {"comment": comment})


_CANONICAL = [
    _field("entity_id", T.IntegerType(), "Number of the company or device that sent the row, as an integer"),
    _field("party_size", T.IntegerType(), "Size of the party. Not every feed fills it, so NULL is normal"),
    _field("amount", T.DecimalType(10, 2), "Money of the row in hundredths. Corrections have a minus sign"),
    _field("start_ts", T.TimestampType(), "When the activity began (UTC); the column a feed calls it by is in its FeedSpec"),
    _field("end_ts", T.TimestampType(), "When the activity ended (UTC); may lie before start_ts in faulty rows"),
    _field("feed", T.StringType(), "Name of the FeedSpec the row was conformed with"),
]
_PERIOD = [
    _field("year", T.IntegerType(), "Year in the landed file's name, whatever the row's times say"),
    _field("month", T.IntegerType(), "Month (1-12) in the landed file's name, whatever the row's times say"),
]

SILVER = T.StructType(
    [
        *_CANONICAL,
        _field("is_amount_valid", T.BooleanType(), "True where the amount, before its cast, was a number of at least zero"),
        *_PERIOD,
        _field("_source_version", T.LongType(), "Commit of the feed's bronze table that brought the row"),
    ]
)
GOLD = T.StructType(
    [
        *_CANONICAL,
        *_PERIOD,
        _field("start_hour", T.IntegerType(), "Clock hour of start_ts, UTC"),
        _field("_source_version", T.LongType(), "Commit of silver that brought the row"),
    ]
)

LAYER_COMMENTS = {
    "bronze": "A table per feed with its files' columns, lowercased, and source_file.",
    "silver": "One table for all feeds; every bronze row has one row here.",
    "gold": "What reports read: silver's rows with the start hour, partitioned by period.",
}
SILVER_COMMENT = "Rows of all feeds under the same names and types. Doubtful amounts carry a flag; no row is left out."
GOLD_COMMENT = "Rows of silver without the flag and with the start hour, in directories by feed, year and month."
SOURCE_FILE_COMMENT = "Landed entry the row was read from; a name that is here is not read again"


def bronze_comment(feed: str) -> str:
    return f"What landed for feed {feed}, a partition per landed entry."


# Directory keys. They are (nearly) constant within an input split, so a hop never shuffles to write.
# Silver keeps year and month inside its files. A task may pack several monthly files, so it sorts its
# rows by period; row groups then cover few months and a period read skips the others.
BRONZE_PARTITIONS = ("source_file",)
SILVER_PARTITIONS = ("feed",)
SILVER_ORDER = ("year", "month")
GOLD_PARTITIONS = ("feed", "year", "month")
