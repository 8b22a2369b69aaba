"""Nothing is lost without an error: drift inside entries, old file times, letter case, missing dates."""

import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import X, Y, land, land_table, values

from tierline import Layers, build, conform, ingest, publish
from tierline.plans.catalog import create_tables, quoted
from tierline.plans.verify import verify_bronze
from tierline.session import REQUIRED, require_settings
from tierline.sources.files import child_names
from tierline.sources.landing import landing_counts
from tierline.sources.versioned import VersionedTable
from tierline.streaming.hops import stream_conform
from workload.feeds import feed_b, land as land_written, scratch_root


def parts(layers, entry: str, *tables: pa.Table) -> None:
    directory = Path(layers.landing("x")) / entry
    directory.mkdir(parents=True)
    for number, table in enumerate(tables):
        pq.write_table(table, directory / f"part-{number}.parquet")


def longs(*entities: int, name: str = "entity_code") -> pa.Table:
    return pa.table({name: pa.array(entities, pa.int64())})


def jobs(spark, action) -> int:
    """Spark jobs that `action` starts on this thread's group."""
    group = f"jobs-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_columns_of_every_part_of_a_directory_arrive(layers):
    fee = pa.array([0.5, None, 0.25])
    parts(layers, "x_2020-01.parquet", longs(1), longs(2, 3, 4).append_column("fee", fee), longs(5, name="ENTITY_CODE"))
    assert ingest(layers, X).rows == 5
    assert values(layers.bronze("x").read(), "entity_code", "fee") == [(1, None), (2, 0.5), (3, None), (4, 0.25), (5, None)]
    verify_bronze(layers, [X])


def test_parts_of_different_width_are_widened(layers):
    parts(layers, "x_2020-01.parquet", pa.table({"entity_code": pa.array([1], pa.int32())}), longs(3_000_000_000))
    assert ingest(layers, X).rows == 2
    assert values(layers.bronze("x").read(), "source_file", "entity_code") == [
        ("x_2020-01.parquet", 1),
        ("x_2020-01.parquet", 3_000_000_000),
    ]


def test_letter_case_is_a_required_setting(layers):
    spark = layers.spark
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        require_settings(spark)
        land_table(layers, "x", "x_2020-01.parquet", longs(1, name="Entity_Code"))
        land_table(layers, "x", "x_2020-02.parquet", longs(2, name="ENTITY_CODE"))
        ingest(layers, X)
        assert values(layers.bronze("x").read(), "entity_code") == [(1,), (2,)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", REQUIRED["spark.sql.caseSensitive"])


def test_stream_reads_commits_with_old_file_times(layers):
    target = Layers(layers.spark, f"{layers.root}-streamed")
    checkpoint = f"{target.root}/checkpoint"
    land(layers, X, "x_2020-01.parquet", [1.0] * 4)
    ingest(layers, X)
    stream_conform(layers, [X], target.silver, checkpoint).awaitTermination()
    land(layers, X, "x_2020-02.parquet", [1.0] * 3)
    ingest(layers, X)
    for file in Path(layers.bronze("x").version_path(1)).rglob("*.parquet"):
        old = file.stat().st_mtime - 9 * 86_400
        os.utime(file, (old, old))
    stream_conform(layers, [X], target.silver, checkpoint).awaitTermination()
    assert target.silver.read().count() == 7


def test_rows_without_a_date_do_not_land_in_silence(spark, tmp_path):
    columns = {
        "o_orderkey": [1, 2], "o_custkey": [1, 1], "o_orderstatus": ["P", "F"], "o_totalprice": [1.0, 2.0],
    }
    dates = pa.array([None, 0], pa.timestamp("us"))
    pq.write_table(pa.table(columns | {"o_orderdate": dates}), tmp_path / "orders.parquet")
    for number, rows in enumerate(feed_b(spark, str(tmp_path))):
        rows.write.partitionBy("entry").parquet(f"{tmp_path}/written/b/{number}")
    with pytest.raises(ValueError, match="no month"):
        land_written(spark, f"{tmp_path}/written", Layers(spark, f"{tmp_path}/root"))


def test_other_folders_below_landing_are_not_entries(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    archive = Path(layers.landing("x")) / "archive"
    archive.mkdir()
    pq.write_table(longs(1, 2, 3), archive / "x.parquet")
    build(layers, [X])
    assert values(landing_counts(layers.spark, {"x": layers.landing("x")})) == [("x", "x_2020-01.parquet", 1)]


@pytest.mark.parametrize("names", [["a, b.parquet", "a,b.parquet", "{a}", "é + %41"]])
def test_listing_keeps_names_whole(spark, tmp_path, names):
    for name in names:
        (tmp_path / name).touch()
    assert child_names(spark, str(tmp_path)) == sorted(names)
    assert child_names(spark, f"{tmp_path}/none") == []


def test_jobs_of_an_ingest_do_not_follow_the_number_of_files(spark, tmp_path):
    default = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")  # listings aside
    try:
        found = set()
        for count in (12, 48):
            layers = Layers(spark, f"{tmp_path}/{count}")
            for number in range(count):
                name = "Entity_Code" if number % 2 else "entity_code"
                land_table(layers, "x", f"x_{2000 + number // 12}-{number % 12 + 1:02}.parquet", longs(1, name=name))
            found.add(jobs(spark, lambda layers=layers: ingest(layers, X)))
    finally:
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", default)
    assert len(found) == 1 and found.pop() <= 8


def test_hops_with_nothing_new_read_records_only(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    land(layers, Y, "y_2020-01.parquet", [1.0])
    build(layers, [X, Y])
    assert layers.silver.watermark("x") == 0 and layers.gold.watermark() == 1
    assert jobs(layers.spark, lambda: (conform(layers, [X, Y]), publish(layers))) <= 3


def test_watermark_without_a_record_of_it_comes_from_the_rows(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    for table in (layers.silver, layers.gold):
        for record in (Path(table.version_path(0)) / "_commit").glob("*.json"):
            record.write_text('{"version":0,"operation":"conform x","rows":1}\n')
            record.with_name(f".{record.name}.crc").unlink(missing_ok=True)
    assert layers.silver.watermark("x") == 0 and layers.gold.watermark() == 0
    assert conform(layers, [X]) == [] and publish(layers) is None


def test_stores_without_atomic_renames_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tierline.sources.versioned.scheme", lambda *_: "s3a")
    rows = spark.range(1).selectExpr("id", "'f' as source_file")
    with pytest.raises(ValueError, match="not known to be atomic"):
        VersionedTable(spark, f"{tmp_path}/t", ("source_file",)).append(rows, "x")
    assert VersionedTable(spark, f"{tmp_path}/t", ("source_file",), any_store=True).append(rows, "x").rows == 1


def test_remote_clients_get_a_clear_error():
    with pytest.raises(RuntimeError, match="classic session"):
        child_names(object(), "/tmp")


def test_staging_of_failed_commits_can_be_removed(layers, monkeypatch):
    land(layers, X, "x_2020-01.parquet", [1.0])

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("tierline.sources.versioned.rename_new", crash)
        with pytest.raises(KeyboardInterrupt):
            ingest(layers, X)
    assert layers.bronze("x").remove_staging() == 1 and layers.bronze("x").remove_staging() == 0


def test_silver_row_groups_follow_the_period(layers):
    for month in (3, 1, 2):
        land(layers, X, f"x_2020-0{month}.parquet", [float(month)] * 40)
    ingest(layers, X)
    layers.spark.conf.set("spark.sql.files.openCostInBytes", "1")  # so that a task gets several files
    try:
        conform(layers, [X])
    finally:
        layers.spark.conf.unset("spark.sql.files.openCostInBytes")
    for file in Path(layers.silver.version_path(0)).rglob("*.parquet"):
        months = pq.read_table(file, partitioning=None).column("month").to_pylist()
        assert months == sorted(months)


def test_run_report_and_documentation(layers):
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])
    report = []
    build(layers, [X], report, document="r_")
    assert [(commit.operation, commit.rows) for commit in report] == [("ingest x", 2), ("conform x", 2), ("publish", 2)]
    assert layers.spark.table("r_gold.activity").count() == 2
    build(layers, [X], report := [])
    assert report == []


def test_comments_with_quotes(layers, monkeypatch):
    text = "it's a \\ backslash"
    assert layers.spark.sql(f"select {quoted(text)} as text").first()["text"] == text
    monkeypatch.setattr("tierline.plans.catalog.GOLD_COMMENT", "the reports' table")
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    create_tables(layers, [X], prefix="q_")
    described = layers.spark.sql("describe table extended q_gold.activity").where("col_name = 'Comment'").first()
    assert described["data_type"] == "the reports' table"


def test_counting_leaves_the_session_alone(layers):
    before = layers.spark.conf.get("spark.sql.sources.useV1SourceList")
    land(layers, X, "x_2020-01.parquet", [1.0])
    build(layers, [X])
    assert layers.spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert layers.spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_scratch_root_is_where_it_is_asked_for(spark, tmp_path):
    assert scratch_root(spark, str(tmp_path)).startswith(f"{tmp_path}/")
