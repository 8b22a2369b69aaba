"""The business questions as parameterised SQL, for users of the catalog's tables or of the views.

Values come as named parameters, never by pasting text; the table's name is one as well (`identifier`).
Each gives what the function of the same purpose in `questions` gives.
"""

from pyspark.sql import DataFrame, SparkSession

_PERIOD = "year = :year and month between :first and :last"

STATEMENTS = {
    "average_amount_per_month": f"""
        select year, month, round(avg(amount), 2) as avg_amount
        from identifier(:gold) where feed = :feed and {_PERIOD}
        group by year, month order by year, month""",
    "average_party_per_hour": """
        select start_hour, round(avg(party_size), 2) as avg_party
        from identifier(:gold) where year = :year and month = :month and party_size > 0
        group by start_hour order by start_hour""",
    "revenue_per_feed_and_month": f"""
        select feed, year, month, count(*) as trips, round(sum(amount), 2) as revenue, round(avg(amount), 2) as avg_ticket
        from identifier(:gold) where {_PERIOD}
        group by feed, year, month order by feed, year, month""",
    "volume_per_hour": """
        select start_hour, count(*) as trips, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct_of_day
        from identifier(:gold) where year = :year and month = :month
        group by start_hour order by start_hour""",
    "rows_since": """
        select feed, _source_version, count(*) as rows, count_if(not is_amount_valid) as doubtful
        from identifier(:silver) where _commit_version >= :start
        group by feed, _source_version order by feed, _source_version""",
}


def ask(spark: SparkSession, statement: str, **parameters: str | int) -> DataFrame:
    """A statement by name, e.g. `ask(spark, "volume_per_hour", gold="gold_activity", year=1998, month=5)`."""
    return spark.sql(STATEMENTS[statement], args=parameters)
