"""Landing files of feeds a, b and c, derived by Spark from lineitem, orders and events.

The rules are those of FIXTURES.md section 4; every row of the three tables lands in exactly one
monthly entry. Parts of a feed whose files have different schemas are written separately. Feed b always
lands as directories of part files that differ in schema; of the other feeds, an entry of one file lands
as that file and an entry of several as a directory.
"""

import re
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import FeedSpec, Layers, build
from tierline.session import require_settings
from tierline.sources.files import child_names, move, remove_at_exit

FEED_A = FeedSpec("a", "a_start_ts", "a_end_ts")
FEED_B = FeedSpec("b", "b_start_ts", "b_end_ts")
FEED_C = FeedSpec("c", "c_start_ts", "c_end_ts")
FEEDS = (FEED_A, FEED_B, FEED_C)
AS_DIRECTORIES = {"b"}
SECOND_RUN_FROM = "2000-01"  # files from this month on land after the first run


def _hours(hours: str):
    return F.expr(f"make_dt_interval(0, cast({hours} as int))")


def feed_a(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    stray = F.expr("make_dt_interval(if(l_orderkey % 97 = 0, 40, 0))")
    start = F.col("l_shipdate") + _hours("l_orderkey % 24") - stray
    amount = F.expr(
        "case when l_quantity = 1 then 0D when l_quantity = 2 then null "
        "when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end"
    )
    late = F.year("l_shipdate") >= 1997

    def shaped(part: DataFrame, entity_type: str, *extra) -> DataFrame:
        return part.select(
            F.col("l_suppkey").cast(entity_type).alias("Entity_Code"),
            F.expr("double(nullif(l_linenumber - 1, 6))").alias("party_size"),
            amount.alias("total_amount"),
            start.alias("a_start_ts"),
            (start + _hours("l_quantity - 3")).alias("a_end_ts"),
            *extra,
            _entry("a", "l_shipdate"),
        )

    surcharge = F.col("l_tax").alias("surcharge")
    return [shaped(rows.where(~late), "int"), shaped(rows.where(late), "bigint", surcharge)]


def feed_b(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start = F.col("o_orderdate") + _hours("o_orderkey % 24")
    odd_key = F.col("o_orderkey") % 2 == 1

    def shaped(part: DataFrame, entity_name: str, *extra) -> DataFrame:
        return part.select(
            F.col("o_custkey").alias(entity_name),
            F.expr("double(o_custkey % 7)").alias("party_size"),
            F.expr("if(o_orderstatus = 'P', -o_totalprice, o_totalprice)").alias("total_amount"),
            start.alias("b_start_ts"),
            (start + _hours("o_orderkey % 5")).alias("b_end_ts"),
            *extra,
            _entry("b", "o_orderdate"),
        )

    status = F.col("o_orderstatus").alias("status")
    return [shaped(rows.where(~odd_key), "Entity_Code"), shaped(rows.where(odd_key), "ENTITY_CODE", status)]


def feed_c(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    minutes = F.expr("make_dt_interval(0, 0, cast(event_id % 60 as int))")
    return [
        rows.select(
            F.col("user_id").alias("Entity_Code"),
            F.expr("double(user_id % 6)").alias("party_size"),
            F.expr("if(event_type = 'error', -value, value)").alias("total_amount"),
            F.col("ts").alias("c_start_ts"),
            (F.col("ts") + minutes).alias("c_end_ts"),
            _entry("c", "ts"),
        )
    ]


def _entry(feed: str, date: str):
    return F.concat(F.lit(f"{feed}_"), F.date_format(date, "yyyy-MM"), F.lit(".parquet")).alias("entry")


DERIVE: dict[str, Callable[[SparkSession, str], list[DataFrame]]] = {
    "a": feed_a,
    "b": feed_b,
    "c": feed_c,
}


def write_entries(spark: SparkSession, sf_dir: str, staging: str) -> None:
    """Write every feed's monthly entries below `staging`.

    Rows are rebalanced by month. Under adaptive execution small months share a task and a hot one
    is split over many, which gives its entry several part files.
    """

    def write(rows: DataFrame, path: str) -> None:
        balanced = spark.sql("select /*+ rebalance(entry) */ * from {rows}", rows=rows)
        balanced.write.partitionBy("entry").parquet(path)

    parts = [
        (rows, f"{staging}/{feed}/{number}")
        for feed, derive in DERIVE.items()
        for number, rows in enumerate(derive(spark, sf_dir))
    ]
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(write, *zip(*parts, strict=True)))


def land(spark: SparkSession, staging: str, layers: Layers, before: str | None = None) -> None:
    """Move written entries (those of months before `before`) into the landing directories.

    Rows without a date have no month to land in, so they are an error, not skipped.
    """
    for feed in DERIVE:
        for part in child_names(spark, f"{staging}/{feed}"):
            for name in child_names(spark, f"{staging}/{feed}/{part}"):
                if name[0] in "_.":  # the writer's own
                    continue
                period = re.search("[0-9]{4}-[0-9]{2}", name)
                if period is None:
                    raise ValueError(f"rows of feed {feed} have no month to land in: {name}")
                if before is not None and period[0] >= before:
                    continue
                source = f"{staging}/{feed}/{part}/{name}"
                files = [file for file in child_names(spark, source) if file.endswith(".parquet")]
                entry = f"{layers.landing(feed)}/{name.removeprefix('entry=')}"
                if feed in AS_DIRECTORIES:
                    for file in files:
                        move(spark, f"{source}/{file}", f"{entry}/{part}-{file}")
                elif len(files) == 1:
                    move(spark, f"{source}/{files[0]}", entry)
                elif files:
                    move(spark, source, entry)


def scratch_root(spark: SparkSession, shared: str | None = None) -> str:
    """A new directory below `shared`, deleted when the session's JVM ends.

    Every executor must reach it: by default it is below the cluster's checkpoint folder, or below the
    machine's temporary one if everything runs in one process.
    """
    if shared is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    root = f"{shared.rstrip('/')}/tierline-{uuid4().hex}"
    remove_at_exit(spark, root)
    return root


_BUILT: dict[tuple[str, str], Layers] = {}
_BUILDING = Lock()


def built_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers of the three feeds, built once per application and input directory.

    Two runs, so that every table has more than one version: the files before SECOND_RUN_FROM
    first, the rest after.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    with _BUILDING:
        if key not in _BUILT:
            require_settings(spark)
            root = scratch_root(spark)
            layers = Layers(spark, f"{root}/prod")
            write_entries(spark, sf_dir, f"{root}/written")
            land(spark, f"{root}/written", layers, before=SECOND_RUN_FROM)
            build(layers, FEEDS)
            land(spark, f"{root}/written", layers)
            build(layers, FEEDS)
            _BUILT[key] = layers
    return _BUILT[key]
