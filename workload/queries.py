"""One query per operator: `QUERIES[name](spark, sf_dir)`.

All run on the layers built from the driver's whole tables. Columns are cast to what the SQL side
returns: counts bigint, calendar parts int, money and ratios double, times without zone.
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import FeedSpec, Layers, build, conform, ingest, publish
from tierline.functions import expressions as E
from tierline.operators import aggregates as A
from tierline.operators import conform as C
from tierline.operators import reconcile as R
from tierline.plans import exploration, quality, questions, verify
from tierline.plans.catalog import create_tables, create_views, described_columns, described_table
from tierline.plans.pipeline import ingest_all, ingested_files
from tierline.plans.statements import ask
from tierline.session import require_settings
from tierline.sources import landing
from tierline.sources.versioned import VersionedTable
from tierline.streaming.hops import stream_conform, stream_feeds, stream_publish
from workload.feeds import FEEDS, built_layers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MAKING = Lock()  # a second environment is made by one query at a time

# the analysis window and hour month, and the feed the one-feed questions ask about
YEAR, FIRST, LAST, HOUR_MONTH, FEED = 1998, 1, 5, 5, "a"
NAMES = [feed.name for feed in FEEDS]


def on_layers(query: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register a function of the built layers under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(built_layers(require_settings(spark), sf_dir))

    QUERIES[query.__name__] = run
    return query


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def zoneless(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def silver_rows(df: DataFrame) -> DataFrame:
    """Silver rows as compared: contract columns only."""
    return zoneless(doubles(df.drop("_commit_version"), "amount"), "start_ts", "end_ts")


gold_rows = silver_rows


def bronze_changes(layers: Layers) -> list[tuple]:
    """(feed, all its bronze rows tagged with their version)."""
    return [(feed, layers.bronze(feed.name).read_inserts_since(0)) for feed in FEEDS]


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of all frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def per_feed(of_feed: Callable[[str], DataFrame]) -> DataFrame:
    """Union of a per-feed frame, labelled with the feed."""
    return stack(of_feed(name).withColumn("feed", F.lit(name)) for name in NAMES)


def over_bronze(layers: Layers, shape: Callable[[DataFrame, FeedSpec], DataFrame]) -> DataFrame:
    """Union of `shape(bronze rows, feed)` over the feeds, labelled with the feed."""
    return stack(
        shape(rows, feed).withColumn("feed", F.lit(feed.name)) for feed, rows in bronze_changes(layers)
    )


def landed_names(layers: Layers, feed: str) -> list[str]:
    return [row["source_file"] for row in landed(layers, feed).collect()]


def landed(layers: Layers, feed: str) -> DataFrame:
    return landing.landed_files(layers.spark, layers.landing(feed))


def or_null(df: DataFrame, name: str, kind: str):
    """The column, or NULL of its type where a feed never had it."""
    column = F.col(name) if name in df.columns else F.lit(None)
    return column.cast(kind).alias(name)


def every_table(layers: Layers, of_table: Callable) -> DataFrame:
    """Union of a frame per table of all layers, labelled with the table."""
    tables = {f"bronze_{name}": layers.bronze(name) for name in NAMES}
    tables |= {"silver": layers.silver, "gold": layers.gold}
    return stack(of_table(table).withColumn("table", F.lit(name)) for name, table in tables.items())


# Scans and sources


@on_layers
def src1_read_clean(layers: Layers) -> DataFrame:
    """Every feed, a scan for each group of its files whose schemas merge."""

    def groups(feed: str) -> DataFrame:
        directory = layers.landing(feed)
        parts = landing.merged_schemas(layers.spark, directory, landed_names(layers, feed))
        return stack(
            landing.read_clean(layers.spark, directory, names, schema).select(
                "source_file", F.col("entity_code").cast("bigint"), "party_size", "total_amount"
            )
            for names, schema in parts
        )

    return per_feed(groups)


@on_layers
def src2_read_new_files(layers: Layers) -> DataFrame:
    """Feed a's files differ in the entity's type and in having a surcharge, the parts of b's directories
    in the case of a name and in having a status."""

    def rows(feed: str) -> DataFrame:
        read = landing.read_new_files(layers.spark, layers.landing(feed), landed_names(layers, feed))
        return read.select(
            "source_file",
            "entity_code",
            "total_amount",
            or_null(read, "surcharge", "double"),
            or_null(read, "status", "string"),
        )

    return per_feed(rows)


@on_layers
def src3_landed_files(layers: Layers) -> DataFrame:
    return per_feed(lambda feed: landed(layers, feed))


@on_layers
def src4_ingested_files(layers: Layers) -> DataFrame:
    return per_feed(lambda feed: ingested_files(layers.bronze(feed)))


@on_layers
def src5_read_inserts_since(layers: Layers) -> DataFrame:
    """Silver rows of every version after the first run's two."""
    return silver_rows(layers.silver.read_inserts_since(2)).drop("start_ts", "end_ts")


def second_environment(layers: Layers) -> Layers:
    """Another root that ingested the same landing files of feed a in a single run."""
    other = Layers(layers.spark, f"{layers.root}-dev")
    with MAKING:
        if not other.bronze("a").exists():
            rows = landing.read_new_files(layers.spark, layers.landing("a"), landed_names(layers, "a"))
            other.bronze("a").append(rows, "ingest a")
    return other


@on_layers
def src7_table_scan(layers: Layers) -> DataFrame:
    """Rows per file of one table in two environments, in one query."""
    environments = {"dev": second_environment(layers), "prod": layers}
    return stack(
        A.count_rows(place.bronze("a").read(), "source_file").withColumn("env", F.lit(env))
        for env, place in environments.items()
    )


# Sinks, contracts, versions


def every_feed_again(layers: Layers) -> Layers:
    """Another root that ingested all feeds' landing files in a single run, with nothing behind bronze."""
    other = BesideLanding(layers.spark, f"{layers.root}-again", landing_root=layers.root)
    with MAKING:
        if not all(other.bronze(name).exists() for name in NAMES):
            ingest_all(other, FEEDS)
    return other


@on_layers
def src7_every_feed(layers: Layers) -> DataFrame:
    """Rows per file of all bronze tables in two environments, in one query."""
    environments = {"dev": every_feed_again(layers), "prod": layers}
    return stack(
        verify.file_counts(place, FEEDS).select("feed", "source_file", F.col("bronze_rows").alias("rows"), F.lit(env).alias("env"))
        for env, place in environments.items()
    )


def views(layers: Layers) -> str:
    """The prefix of the temporary views of these layers' tables."""
    prefix = "sql_"
    create_views(layers, FEEDS, prefix)
    return prefix


@on_layers
def src6_avg_amount_sql(layers: Layers) -> DataFrame:
    """The first question as SQL over the views; the same as agg14."""
    gold = f"{views(layers)}gold_activity"
    answer = ask(layers.spark, "average_amount_per_month", gold=gold, feed=FEED, year=YEAR, first=FIRST, last=LAST)
    return doubles(answer, "avg_amount")


@on_layers
def src6_avg_party_sql(layers: Layers) -> DataFrame:
    gold = f"{views(layers)}gold_activity"
    return doubles(ask(layers.spark, "average_party_per_hour", gold=gold, year=YEAR, month=HOUR_MONTH), "avg_party")


@on_layers
def src6_revenue_sql(layers: Layers) -> DataFrame:
    gold = f"{views(layers)}gold_activity"
    answer = ask(layers.spark, "revenue_per_feed_and_month", gold=gold, year=YEAR, first=FIRST, last=LAST)
    return doubles(answer, "revenue", "avg_ticket")


@on_layers
def src6_volume_sql(layers: Layers) -> DataFrame:
    gold = f"{views(layers)}gold_activity"
    return doubles(ask(layers.spark, "volume_per_hour", gold=gold, year=YEAR, month=HOUR_MONTH), "pct_of_day")


@on_layers
def src6_changes_sql(layers: Layers) -> DataFrame:
    """A change batch as SQL: silver's rows of the second run."""
    return ask(layers.spark, "rows_since", silver=f"{views(layers)}silver_activity", start=2)


def registered(layers: Layers) -> dict[str, str]:
    """The layers' tables in the session catalog, by a short name."""
    with MAKING:
        names = create_tables(layers, FEEDS, prefix="check_")
    return {name.replace("`", "").removeprefix("check_").replace(".", "_").replace("_activity", ""): name for name in names}


@on_layers
def snk4_contract(layers: Layers) -> DataFrame:
    """The contracts of silver and gold as the catalog tells them, and how many rows fill each column."""
    tables = registered(layers)

    def columns(name: str) -> DataFrame:
        table = layers.spark.table(tables[name])
        filled = table.agg(*[F.count(column).alias(column) for column in table.columns])
        filled = filled.unpivot([], table.columns, "col_name", "filled")
        listed = described_columns(layers.spark, tables[name])
        return listed.join(filled, "col_name").select(
            F.lit(name).alias("table"), "col_name", "data_type", F.col("comment").isNotNull().alias("documented"), "filled"
        )

    return stack(columns(name) for name in ("silver", "gold"))


@on_layers
def snk4_question_by_catalog(layers: Layers) -> DataFrame:
    """The first question asked of the registered gold table; only its directories of the period are read."""
    gold = registered(layers)["gold"].replace("`", "")
    answer = ask(layers.spark, "average_amount_per_month", gold=gold, feed=FEED, year=YEAR, first=FIRST, last=LAST)
    return doubles(answer, "avg_amount")


@on_layers
def snk5_documentation(layers: Layers) -> DataFrame:
    """Every registered table's comment and rows."""
    spark = layers.spark
    return stack(
        A.count_rows(spark.table(name)).crossJoin(described_table(spark, name)).withColumn("table", F.lit(short))
        for short, name in registered(layers).items()
    )


RANGE_ROWS = 5000  # rows of a file of the range layout below


def ranged(layers: Layers) -> Layers:
    """Silver of a second environment over the first one's bronze, laid out in ranges of period."""
    other = BesideBronze(layers.spark, f"{layers.root}-ranged", bronze_root=layers.root)
    with MAKING:
        if not other.silver.exists():
            conform(other, FEEDS, file_rows=RANGE_ROWS)
    return other


@on_layers
def snk6_range_layout(layers: Layers) -> DataFrame:
    """Rows per feed and period of the range layout, and whether few files hold the period: as many as its
    rows fill, with room for uneven cuts, and one more at either end."""
    path = F.col("_metadata.file_path").alias("path")
    rows = ranged(layers).silver.read().select("feed", "year", "month", path)
    per_period = rows.groupBy("feed", "year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("path").alias("files")
    )
    few = F.col("files") <= 2 + F.ceil(2 * F.col("rows") / RANGE_ROWS)
    return per_period.select("feed", "year", "month", "rows", few.alias("in_few_files"))


@on_layers
def flt5_empty_batch(layers: Layers) -> DataFrame:
    """An environment with the last entry of each feed and one without rows, ingested twice: what landed, what
    bronze has, and how often it was written."""
    sparse = Layers(layers.spark, f"{layers.root}-sparse")

    def landed_again(name: str) -> None:
        bronze = layers.bronze(name)
        last = bronze.listed_partitions("source_file").agg(F.max("source_file").alias("entry")).first()["entry"]
        rows = bronze.read().where(F.col("source_file") == last).drop("source_file", "_commit_version")
        rows.write.mode("overwrite").parquet(f"{sparse.landing(name)}/{last}")
        rows.limit(0).write.mode("overwrite").parquet(f"{sparse.landing(name)}/{name}_2099-12.parquet")

    with MAKING:
        if not sparse.bronze("c").exists():
            for name in NAMES:
                landed_again(name)
            ingest_all(sparse, FEEDS)
            ingest_all(sparse, FEEDS)
    counts = landing.landing_counts(layers.spark, {name: sparse.landing(name) for name in NAMES})
    landed_rows = counts.groupBy("feed").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("landing_rows") == 0).alias("empty_entries"),
        F.sum("landing_rows").alias("landing_rows"),
    )
    written = per_feed(
        lambda name: sparse.bronze(name).history().agg(F.count(F.lit(1)).alias("commits"), F.sum("rows").alias("bronze_rows"))
    )
    return landed_rows.join(written, "feed")


@on_layers
def snk1_bronze_append(layers: Layers) -> DataFrame:
    """Bronze after all appends; a's second one extended the table's type-drifted files."""

    def per_commit(feed: str) -> DataFrame:
        rows = layers.bronze(feed).read()
        return rows.groupBy("_commit_version").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(or_null(rows, "surcharge", "double")).alias("with_surcharge"),
            F.count(or_null(rows, "status", "string")).alias("with_status"),
            F.sum(F.col("entity_code").cast("bigint")).alias("entity_sum"),
        )

    return per_feed(per_commit)


@on_layers
def snk2_silver_insert(layers: Layers) -> DataFrame:
    return silver_rows(layers.silver.read())


@on_layers
def snk3_gold_insert(layers: Layers) -> DataFrame:
    return gold_rows(layers.gold.read())


@on_layers
def snk6_period_layout(layers: Layers) -> DataFrame:
    """Rows per feed and period in silver and gold. What is a directory there is taken from the path: the
    feed in silver, all three in gold."""
    path = F.col("_metadata.file_path")
    feed = F.regexp_extract(path, "/feed=([^/]+)/", 1).alias("feed")
    gold = layers.gold.read().select(
        F.lit("gold").alias("layer"),
        feed,
        F.regexp_extract(path, "/year=([0-9]+)/", 1).cast("int").alias("year"),
        F.regexp_extract(path, "/month=([0-9]+)/", 1).cast("int").alias("month"),
    )
    silver = layers.silver.read().select(F.lit("silver").alias("layer"), feed, "year", "month")
    return A.count_rows(gold.unionByName(silver), "layer", "feed", "year", "month")


@on_layers
def ver1_last_version(layers: Layers) -> DataFrame:
    def last(table, name: str) -> DataFrame:
        versions = table.history().agg(F.max("version").alias("version"))
        return versions.withColumn("table", F.lit(name))

    frames = [last(layers.bronze(name), f"bronze_{name}") for name in NAMES]
    frames += [last(layers.silver, "silver"), last(layers.gold, "gold")]
    return stack(frames)


@on_layers
def ver2_table_version(layers: Layers) -> DataFrame:
    """Watermark of each feed in silver, of one that is not there, and of gold."""
    parts = {
        f"silver_{name}": layers.silver.read().where(F.col("feed") == name) for name in [*NAMES, "none"]
    }
    parts["gold"] = layers.gold.read()
    return stack(E.max_source_version(df).withColumn("target", F.lit(name)) for name, df in parts.items())


@on_layers
def ver3_written_rows(layers: Layers) -> DataFrame:
    """Rows of each table's last commit."""
    return every_table(layers, lambda table: table.last_commit().select("version", "rows"))


@on_layers
def ver4_load_history(layers: Layers) -> DataFrame:
    return layers.silver.history().select("version", "operation", "rows")


@on_layers
def lim1_latest_commit(layers: Layers) -> DataFrame:
    """The newest commit of each table, and the highest source version it brought."""
    return every_table(
        layers, lambda table: table.last_commit().select("version", "operation", "rows", "source_version")
    )


# Projections, filters, predicates


@on_layers
def prj1_conform_to_table(layers: Layers) -> DataFrame:
    """Every feed's files read afresh and cast to the types of the table they went into."""

    def rows(feed: str) -> DataFrame:
        read = landing.read_new_files(layers.spark, layers.landing(feed), landed_names(layers, feed))
        cast = C.conform_to_table(read, layers.bronze(feed).schema())
        return cast.select(
            "source_file",
            F.col("entity_code").cast("bigint"),
            "party_size",
            or_null(cast, "surcharge", "double"),
            or_null(cast, "status", "string"),
        )

    return per_feed(rows)


@on_layers
def prj2_silver_projection(layers: Layers) -> DataFrame:
    return silver_rows(stack(C.to_silver(rows, feed) for feed, rows in bronze_changes(layers)))


@on_layers
def prj3_gold_projection(layers: Layers) -> DataFrame:
    return gold_rows(C.to_gold(layers.silver.read_inserts_since(0)))


def filled_columns(rows: DataFrame, name: str) -> DataFrame:
    """A row per column: its name, and how many rows fill it."""
    return rows.agg(*[F.count(column).alias(column) for column in rows.columns]).unpivot([], rows.columns, name, "filled")


@on_layers
def prj4_feed_columns(layers: Layers) -> DataFrame:
    """The raw column behind each canonical one, as the feed's spec names it, and how many rows fill it."""

    def mapped(rows: DataFrame, feed: FeedSpec) -> DataFrame:
        raw = {
            "entity_id": feed.entity_col,
            "party_size": feed.party_col,
            "amount": feed.amount_col,
            "start_ts": feed.start_col,
            "end_ts": feed.end_col,
        }
        names = F.create_map(*[F.lit(name) for pair in raw.items() for name in pair])
        filled = filled_columns(rows.select(*[F.col(column).alias(name) for name, column in raw.items()]), "canonical")
        return filled.withColumn("raw_column", F.element_at(names, F.col("canonical")))

    return over_bronze(layers, mapped)


@on_layers
def prj5_validity_flag(layers: Layers) -> DataFrame:
    flagged = over_bronze(
        layers,
        lambda rows, feed: rows.select(E.is_valid_amount(F.col(feed.amount_col)).alias("is_amount_valid")),
    )
    return A.count_rows(flagged, "feed", "is_amount_valid")


@on_layers
def prj6_identifier_parameter(layers: Layers) -> DataFrame:
    picked = over_bronze(
        layers, lambda rows, feed: C.pick_column(rows, feed.start_col, "start_ts", keep=("source_file",))
    )
    return A.value_range(picked, "start_ts", "feed", "source_file", first="earliest", last="latest")


@on_layers
def flt1_inserts_only(layers: Layers) -> DataFrame:
    """The change batches of every table: rows that each version inserted. Nothing else changes a table."""
    return every_table(
        layers, lambda table: A.count_rows(table.read_inserts_since(0), "_source_version", alias="inserted")
    )


@on_layers
def flt2_period_filter(layers: Layers) -> DataFrame:
    scope = questions.in_months(layers.gold.read(), YEAR, FIRST, LAST).where(F.col("feed") == FEED)
    return gold_rows(scope)


@on_layers
def flt3_positive_filter(layers: Layers) -> DataFrame:
    return A.count_rows(layers.gold.read().where(F.col("party_size") > 0), "feed", "party_size")


@on_layers
def flt4_column_comparison(layers: Layers) -> DataFrame:
    rows = layers.gold.read().where(F.col("end_ts") < F.col("start_ts"))
    return zoneless(rows.select("feed", "year", "month", "entity_id", "start_ts", "end_ts"), "start_ts", "end_ts")


@on_layers
def flt6_case_bucketing(layers: Layers) -> DataFrame:
    bucket = E.amount_bucket(F.col("amount")).alias("bucket")
    return A.count_rows(layers.gold.read().select("feed", bucket), "feed", "bucket")


# Joins


@on_layers
def jn1_new_files(layers: Layers) -> DataFrame:
    """What a bronze that has only the first run's files would still have to read."""


    def new(feed: str) -> DataFrame:
        first_run = layers.bronze(feed).read_inserts_since(0, 0).select("source_file").distinct()
        return R.new_files(landed(layers, feed), first_run)

    return per_feed(new)


@on_layers
def jn2_landing_vs_bronze(layers: Layers) -> DataFrame:
    """Landing against the bronze rows of the first run only: the second run's files differ."""
    first_run = per_feed(
        lambda feed: A.count_rows(
            layers.bronze(feed).read_inserts_since(0, 0), "source_file", alias="bronze_rows"
        )
    )
    in_landing = landing.landing_counts(layers.spark, {name: layers.landing(name) for name in NAMES})
    return R.reconcile_left(in_landing, first_run, ["feed", "source_file"], ("landing_rows", "bronze_rows"))


@on_layers
def jn3_silver_vs_gold(layers: Layers) -> DataFrame:
    """Silver's second run against gold's first: every feed differs, one is on one side only."""
    silver = A.count_rows(layers.silver.read_inserts_since(2), "feed", alias="silver_rows")
    gold = A.count_rows(layers.gold.read_inserts_since(0, 0), "feed", alias="gold_rows")
    return R.reconcile_both(silver, gold, ["feed"], ("silver_rows", "gold_rows"))


@on_layers
def jn4_bronze_vs_silver(layers: Layers) -> DataFrame:
    """All of bronze against silver's first run, for a fixed list with one unknown feed."""
    keys = verify.feed_frame(layers.spark, [*NAMES, "none"])
    bronze = verify.bronze_totals(layers, FEEDS, "bronze_rows")
    silver = A.count_rows(layers.silver.read_inserts_since(0, 1), "feed", alias="silver_rows")
    return R.reconcile_fixed(keys, bronze, silver, ["feed"], ("bronze_rows", "silver_rows"))


@on_layers
def jn5_missing_periods(layers: Layers) -> DataFrame:
    """Months from 1994 on that feed a and b lack; c's latest month ends its default range."""

    def missing(feed: str) -> DataFrame:
        names = landed(layers, feed)
        name = F.col("source_file")
        periods = names.select(E.file_year(name).alias("year"), E.file_month(name).alias("month"))
        end = None if feed == "c" else "2003-06"
        return R.missing_periods(periods, "1994-01", end)

    return per_feed(missing)


# Aggregations


@on_layers
def agg1_rows_per_file(layers: Layers) -> DataFrame:
    return verify.file_counts(layers, FEEDS)


@on_layers
def agg2_landing_counts(layers: Layers) -> DataFrame:
    return landing.landing_counts(layers.spark, {name: layers.landing(name) for name in NAMES})


@on_layers
def agg3_global_count(layers: Layers) -> DataFrame:
    """All rows of all bronze tables, in one number."""
    return A.count_rows(stack(layers.bronze(name).read().select("source_file") for name in NAMES))


@on_layers
def agg4_count_per_feed(layers: Layers) -> DataFrame:
    return verify.feed_totals(layers.silver)


@on_layers
def agg5_distinct_files(layers: Layers) -> DataFrame:
    return per_feed(
        lambda feed: layers.bronze(feed).read().agg(
            F.count_distinct("source_file").alias("files"), F.count(F.lit(1)).alias("rows")
        )
    )


@on_layers
def agg6_month_coverage(layers: Layers) -> DataFrame:
    return exploration.month_coverage(layers.gold.read())


@on_layers
def agg7_start_range(layers: Layers) -> DataFrame:
    return zoneless(exploration.start_range(layers.gold.read()), "first_start", "last_start")


@on_layers
def agg8_entity_distribution(layers: Layers) -> DataFrame:
    return exploration.entity_distribution(layers.gold.read())


@on_layers
def agg9_party_distribution(layers: Layers) -> DataFrame:
    return exploration.party_distribution(layers.gold.read())


@on_layers
def agg10_amount_histogram(layers: Layers) -> DataFrame:
    return exploration.amount_histogram(layers.gold.read())


@on_layers
def agg11_null_audit(layers: Layers) -> DataFrame:
    return quality.null_audit(layers.gold.read())


@on_layers
def agg12_validity_split(layers: Layers) -> DataFrame:
    return doubles(quality.validity_split(layers.silver.read()), "min_amount", "max_amount")


@on_layers
def agg13_bad_intervals(layers: Layers) -> DataFrame:
    return quality.bad_intervals(layers.gold.read())


@on_layers
def agg14_avg_amount_per_month(layers: Layers) -> DataFrame:
    answer = questions.average_amount_per_month(layers.gold.read(), FEED, YEAR, FIRST, LAST)
    return doubles(answer, "avg_amount")


@on_layers
def agg15_avg_party_per_hour(layers: Layers) -> DataFrame:
    return doubles(questions.average_party_per_hour(layers.gold.read(), YEAR, HOUR_MONTH), "avg_party")


@on_layers
def agg16_revenue_per_feed(layers: Layers) -> DataFrame:
    answer = questions.revenue_per_feed_and_month(layers.gold.read(), YEAR, FIRST, LAST)
    return doubles(answer, "revenue", "avg_ticket")


@on_layers
def agg17_volume_per_hour(layers: Layers) -> DataFrame:
    return doubles(questions.volume_per_hour(layers.gold.read(), YEAR, HOUR_MONTH), "pct_of_day")


@on_layers
def agg18_trips_pivot(layers: Layers) -> DataFrame:
    return questions.trips_pivot(layers.gold.read(), NAMES, YEAR)


@on_layers
def agg18_revenue_pivot(layers: Layers) -> DataFrame:
    answer = questions.revenue_pivot(layers.gold.read(), NAMES, YEAR, FIRST, LAST)
    return doubles(answer, *NAMES)


# Windows, sorts, set operations


@on_layers
def win1_share_per_feed(layers: Layers) -> DataFrame:
    return doubles(exploration.share_per_feed(layers.gold.read()), "pct")


@on_layers
def win2_share_per_hour(layers: Layers) -> DataFrame:
    """The share's denominator is the filtered total, here of one year."""
    scope = questions.in_months(layers.gold.read(), YEAR, 1, 12)
    return doubles(A.count_with_share(scope, "feed", "start_hour"), "pct")


@on_layers
def srt1_multi_key_sort(layers: Layers) -> DataFrame:
    return quality.layer_reconciliation(layers, FEEDS)


@on_layers
def srt2_descending_by_count(layers: Layers) -> DataFrame:
    rows = A.count_rows(layers.gold.read(), "year", "month", alias="rows")
    return rows.orderBy(F.desc("rows"))


@on_layers
def srt3_sort_by_hidden_aggregate(layers: Layers) -> DataFrame:
    months = layers.gold.read().groupBy("feed", "year").agg(
        F.count("amount").alias("amounts"), F.min("amount").alias("lowest")
    )
    return months.orderBy("lowest").drop("lowest")


@on_layers
def set1_rows_per_bronze_table(layers: Layers) -> DataFrame:
    return exploration.rows_per_bronze_table(layers, FEEDS)


@on_layers
def set2_rows_per_layer(layers: Layers) -> DataFrame:
    return exploration.rows_per_layer(layers, FEED)


@on_layers
def set2_every_feed(layers: Layers) -> DataFrame:
    return stack(exploration.rows_per_layer(layers, name).withColumn("feed", F.lit(name)) for name in NAMES)


@on_layers
def set4_every_feed(layers: Layers) -> DataFrame:
    environments = {"dev": every_feed_again(layers), "prod": layers}
    return stack(
        exploration.compare_environments(environments, name).withColumn("feed", F.lit(name)) for name in NAMES
    )


@on_layers
def srt1_month_rows_sorted(layers: Layers) -> DataFrame:
    """Month coverage of all layers, by feed, year, month and layer."""
    keys = ("feed", "year", "month")
    parts = {"silver": layers.silver.read(), "gold": layers.gold.read()}
    counted = stack(A.count_rows(rows, *keys).withColumn("layer", F.lit(name)) for name, rows in parts.items())
    return counted.orderBy(*keys, "layer")


@on_layers
def set3_files_and_rows(layers: Layers) -> DataFrame:
    return exploration.files_and_rows(layers, FEEDS)


@on_layers
def set4_environments(layers: Layers) -> DataFrame:
    environments = {"dev": second_environment(layers), "prod": layers}
    return exploration.compare_environments(environments, "a")


@on_layers
def set5_layer_reconciliation(layers: Layers) -> DataFrame:
    return quality.layer_reconciliation(layers, FEEDS)


@on_layers
def set6_union_by_name(layers: Layers) -> DataFrame:
    """All bronze tables by name: only a has a surcharge and only b a status, so the others' are NULL."""
    tables = [layers.bronze(feed.name).read().drop(feed.start_col, feed.end_col) for feed in FEEDS]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)
    return rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("surcharge").alias("with_surcharge"),
        F.count("status").alias("with_status"),
    )


# Scalar functions


@on_layers
def sc1_cast_to_int(layers: Layers) -> DataFrame:
    cast = over_bronze(
        layers, lambda rows, feed: rows.select(F.col(feed.party_col).cast("int").alias("party_size"))
    )
    return A.count_rows(cast, "feed", "party_size")


@on_layers
def sc2_cast_to_decimal(layers: Layers) -> DataFrame:
    cast = over_bronze(
        layers,
        lambda rows, feed: rows.select(
            "source_file", F.col(feed.amount_col).cast("decimal(10,2)").alias("amount")
        ),
    )
    totals = cast.groupBy("feed", "source_file").agg(F.sum("amount").alias("total"))
    return doubles(totals, "total")


@on_layers
def sc3_cast_to_timestamp(layers: Layers) -> DataFrame:
    cast = over_bronze(
        layers,
        lambda rows, feed: rows.select(
            "source_file",
            F.col(feed.start_col).cast("timestamp").alias("start_ts"),
            F.col(feed.end_col).cast("timestamp").alias("end_ts"),
        ),
    )
    ranges = cast.groupBy("feed", "source_file").agg(
        F.min("start_ts").alias("first_start"), F.max("end_ts").alias("last_end")
    )
    return zoneless(ranges, "first_start", "last_end")


@on_layers
def sc4_coalesce(layers: Layers) -> DataFrame:
    flags = over_bronze(
        layers,
        lambda rows, feed: rows.select(
            "source_file", F.coalesce(F.col(feed.amount_col) >= 0, F.lit(False)).cast("int").alias("valid")
        ),
    )
    return flags.groupBy("feed", "source_file").agg(F.sum("valid").alias("valid_rows"))


@on_layers
def sc5_regexp_extract(layers: Layers) -> DataFrame:
    name = F.col("source_file")
    periods = over_bronze(
        layers,
        lambda rows, feed: rows.select(
            "source_file", E.file_year(name).alias("year"), E.file_month(name).alias("month")
        ),
    )
    return A.count_rows(periods, "feed", "source_file", "year", "month")


@on_layers
def sc6_hour(layers: Layers) -> DataFrame:
    return A.count_rows(layers.silver.read().select("feed", F.hour("start_ts").alias("hour")), "feed", "hour")


@on_layers
def sc7_round(layers: Layers) -> DataFrame:
    """Rounded means over fine groups, where exact halves occur."""
    keys = ("feed", "entity_id", "year", "month")
    return doubles(A.rounded_mean(layers.gold.read(), "amount", *keys, alias="avg_amount"), "avg_amount")


@on_layers
def sc8_case_when(layers: Layers) -> DataFrame:
    nulls = layers.gold.read().groupBy("feed", "year").agg(
        E.null_count("amount").alias("null_amount"), E.null_count("party_size").alias("null_party")
    )
    return nulls


@on_layers
def sc9_comparisons(layers: Layers) -> DataFrame:
    gold = layers.gold.read()
    rows = gold.where(F.col("amount").between(-100, 100) & (F.col("party_size").isNull() | (F.col("party_size") >= 2)))
    return A.count_rows(rows, "feed", "year")


@on_layers
def sc10_decimal_arithmetic(layers: Layers) -> DataFrame:
    return doubles(A.count_with_share(layers.gold.read(), "year", "month"), "pct")


@on_layers
def sc11_literal_label(layers: Layers) -> DataFrame:
    return over_bronze(layers, lambda rows, feed: A.count_rows(rows).withColumn("layer", F.lit("bronze")))


@on_layers
def sc12_lowercase_names(layers: Layers) -> DataFrame:
    """The columns of all landed files under their lowercased names, and how many rows fill them. Feed b's
    parts write one name in two ways."""

    def columns(feed: str) -> DataFrame:
        read = landing.read_new_files(layers.spark, layers.landing(feed), landed_names(layers, feed))
        return filled_columns(read, "column_name")

    return per_feed(columns)


@on_layers
def sc13_month_index(layers: Layers) -> DataFrame:
    index = E.month_index(F.col("year"), F.col("month")).alias("month_index")
    counts = A.count_rows(layers.gold.read().select(index), "month_index")
    return counts.withColumn("period", E.month_of_index(F.col("month_index")))


# Streams and whole hops


def streamed(layers: Layers) -> Layers:
    """Silver and gold of a second environment, made by streams over the first one's bronze."""
    target = Layers(layers.spark, f"{layers.root}-streamed")
    checkpoint = f"{target.root}/checkpoint"
    with MAKING:
        if not target.gold.exists():
            stream_conform(layers, FEEDS, target.silver, f"{checkpoint}/silver").awaitTermination()
            stream_publish(target.silver, target.gold, f"{checkpoint}/gold").awaitTermination()
    return target


@on_layers
def st1_stream_conform(layers: Layers) -> DataFrame:
    return silver_rows(streamed(layers).silver.read())


@on_layers
def st1_stream_publish(layers: Layers) -> DataFrame:
    return gold_rows(streamed(layers).gold.read()).drop("_source_version")


@on_layers
def st1_feed_added(layers: Layers) -> DataFrame:
    """Silver by a stream per feed: a and b in one run, then all, into the same target with the same checkpoints."""
    target = Layers(layers.spark, f"{layers.root}-joined")
    with MAKING:
        if not target.silver.exists():
            for feeds in (FEEDS[:2], FEEDS):
                stream_feeds(layers, feeds, target.silver, f"{target.root}/checkpoint")
    return A.count_rows(target.silver.read(), "feed", "year", "month", "_source_version")


@on_layers
def pl1_ingest(layers: Layers) -> DataFrame:
    """Bronze after both runs, and after a third that finds nothing new."""
    for feed in FEEDS:
        ingest(layers, feed)
    return per_feed(
        lambda name: A.count_rows(layers.bronze(name).read(), "source_file", "_commit_version")
    )


@on_layers
def pl2_conform(layers: Layers) -> DataFrame:
    """Silver after both runs, and after a third that finds nothing new."""
    conform(layers, FEEDS)
    return A.count_rows(layers.silver.read(), "feed", "_commit_version", "_source_version")


@on_layers
def pl3_publish(layers: Layers) -> DataFrame:
    """Gold after both runs, and after a third that finds nothing new."""
    publish(layers)
    return A.count_rows(layers.gold.read(), "feed", "_commit_version", "_source_version")


@dataclass(frozen=True)
class BesideBronze(Layers):
    """Later tables of their own over another environment's bronze."""

    bronze_root: str = ""

    def bronze(self, feed: str) -> VersionedTable:
        return Layers(self.spark, self.bronze_root).bronze(feed)


@dataclass(frozen=True)
class BesideLanding(Layers):
    """Tables of their own over another environment's landing directories."""

    landing_root: str = ""

    def landing(self, feed: str) -> str:
        return f"{self.landing_root}/landing/{feed}"


def faulty(layers: Layers) -> Layers:
    """An environment with faults in every layer: bronze lacks a's and b's second run and has c's rows twice,
    silver has the second run only, gold the first only."""
    other = BesideLanding(layers.spark, f"{layers.root}-faulty", landing_root=layers.root)
    with MAKING:
        if not other.gold.exists():

            def copy(source, target, versions: str) -> None:
                target.append(source.read().where(versions).drop("_commit_version"), "copy")

            for name in [*NAMES, "c"]:
                copy(layers.bronze(name), other.bronze(name), "_commit_version = 0")
            copy(layers.silver, other.silver, "_commit_version >= 2")
            copy(layers.gold, other.gold, "_commit_version = 0")
    return other


@on_layers
def pl4_verify_bronze(layers: Layers) -> DataFrame:
    """What the gate finds in the faulty environment."""
    return verify.bronze_mismatches(faulty(layers), FEEDS)


@on_layers
def pl5_verify_silver(layers: Layers) -> DataFrame:
    return verify.silver_mismatches(faulty(layers), FEEDS)


@on_layers
def pl6_verify_gold(layers: Layers) -> DataFrame:
    return verify.gold_mismatches(faulty(layers))


@on_layers
def pl4_passing_bronze(layers: Layers) -> DataFrame:
    """The same gate over whole layers: no rows."""
    return verify.bronze_mismatches(layers, FEEDS)


@on_layers
def pl5_passing_silver(layers: Layers) -> DataFrame:
    return verify.silver_mismatches(layers, FEEDS)


@on_layers
def pl6_passing_gold(layers: Layers) -> DataFrame:
    return verify.gold_mismatches(layers)


@on_layers
def pl7_build(layers: Layers) -> DataFrame:
    """Everything run again, gates included, then the amounts per feed and month."""
    gold = build(layers, FEEDS)
    return questions.in_months(gold, YEAR, 1, 12).groupBy("feed", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("double").alias("revenue")
    )
