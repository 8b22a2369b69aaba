"""Landing to bronze: drift, identity of files, reruns, crashes."""

import pyarrow as pa
import pytest
from conftest import X, land, land_table, raw_rows, values

from tierline import ingest
from tierline.operators.conform import conform_to_table
from tierline.plans.pipeline import ingested_files
from tierline.plans.verify import ReconciliationError, bronze_mismatches, verify_bronze
from tierline.sources.landing import landed_files, landing_counts
from tierline.sources.versioned import VersionedTable


def ints(*entities: int) -> pa.Table:
    return pa.table({"Entity_Code": pa.array(entities, pa.int32())})


def longs(*entities: int) -> pa.Table:
    return pa.table({"entity_code": pa.array(entities, pa.int64())})


def types(layers) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in layers.bronze("x").read().schema}


def test_drift_within_a_batch_is_widened_and_absent_columns_are_null(layers):
    land_table(layers, "x", "x_2020-01.parquet", ints(1))
    land_table(layers, "x", "x_2020-02.parquet", longs(3_000_000_000))
    land_table(layers, "x", "x_2020-03.parquet", longs(3).append_column("fee", pa.array([0.5])))
    assert ingest(layers, X).rows == 3
    assert types(layers) == {
        "entity_code": "bigint",
        "fee": "double",
        "source_file": "string",
        "_commit_version": "bigint",
    }
    assert values(layers.bronze("x").read(), "source_file", "entity_code", "fee") == [
        ("x_2020-01.parquet", 1, None),
        ("x_2020-02.parquet", 3_000_000_000, None),
        ("x_2020-03.parquet", 3, 0.5),
    ]


def test_text_and_integer_in_one_batch_meet_as_bigint(layers):
    land_table(layers, "x", "x_2020-01.parquet", ints(1))
    land_table(layers, "x", "x_2020-02.parquet", pa.table({"entity_code": ["7"]}))
    ingest(layers, X)
    assert types(layers)["entity_code"] == "bigint"
    assert values(layers.bronze("x").read(), "entity_code") == [(1,), (7,)]


def test_later_drift_is_cast_to_the_table_and_new_columns_extend_it(layers):
    land_table(layers, "x", "x_2020-01.parquet", ints(1))
    ingest(layers, X)
    land_table(layers, "x", "x_2020-02.parquet", longs(2).append_column("fee", pa.array([0.5])))
    ingest(layers, X)
    land_table(layers, "x", "x_2020-03.parquet", longs(3))
    ingest(layers, X)
    assert types(layers)["entity_code"] == "int"
    assert values(layers.bronze("x").read(), "_commit_version", "entity_code", "fee") == [
        (0, 1, None),
        (1, 2, 0.5),
        (2, 3, None),
    ]


def test_later_value_that_does_not_fit_raises_and_commits_nothing(layers):
    land_table(layers, "x", "x_2020-01.parquet", ints(1))
    ingest(layers, X)
    land_table(layers, "x", "x_2020-02.parquet", longs(3_000_000_000))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        ingest(layers, X)
    assert layers.bronze("x").versions() == [0]


def test_column_names_differing_in_case_are_one_column(layers):
    land_table(layers, "x", "x_2020-01.parquet", pa.table({"PlaceID": pa.array([1], pa.int64())}))
    land_table(layers, "x", "x_2020-02.parquet", pa.table({"placeid": pa.array([2], pa.int64())}))
    ingest(layers, X)
    assert values(layers.bronze("x").read(), "placeid") == [(1,), (2,)]


def test_empty_file_never_enters_bronze_and_still_reconciles(layers):
    land(layers, X, "x_2020-01.parquet", [])
    assert ingest(layers, X) is None
    assert not layers.bronze("x").exists()
    assert values(landing_counts(layers.spark, {"x": layers.landing("x")})) == [("x", "x_2020-01.parquet", 0)]
    verify_bronze(layers, [X])
    land(layers, X, "x_2020-02.parquet", [1.0])
    assert ingest(layers, X).rows == 1
    assert values(ingested_files(layers.bronze("x"))) == [("x_2020-02.parquet",)]
    verify_bronze(layers, [X])
    assert ingest(layers, X) is None
    assert layers.bronze("x").versions() == [0]


def test_identity_is_the_file_name(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    ingest(layers, X)
    land(layers, X, "x_2020-01 copy.parquet", [1.0])
    assert ingest(layers, X).rows == 1
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])
    assert ingest(layers, X) is None
    assert values(bronze_mismatches(layers, [X])) == [("x", "x_2020-01.parquet", 2, 1)]
    with pytest.raises(ReconciliationError, match="1 case"):
        verify_bronze(layers, [X])


@pytest.mark.parametrize("name", ["x 2020-01+%41=&.parquet", "é_2020-01#.parquet"])
def test_unusual_file_names_survive(layers, name):
    land(layers, X, name, [1.0])
    assert ingest(layers, X).rows == 1
    assert values(layers.bronze("x").read(), "source_file") == [(name,)]
    assert values(ingested_files(layers.bronze("x"))) == [(name,)]
    verify_bronze(layers, [X])
    assert ingest(layers, X) is None


def test_entry_may_be_a_directory_of_part_files(layers):
    rows = layers.spark.range(100).selectExpr("id as entity_code")
    rows.repartition(4).write.parquet(f"{layers.landing('x')}/x_2020-01.parquet")
    land_table(layers, "x", "x_2020-02.parquet", longs(1))
    assert ingest(layers, X).rows == 101
    verify_bronze(layers, [X])
    assert values(landing_counts(layers.spark, {"x": layers.landing("x")})) == [
        ("x", "x_2020-01.parquet", 100),
        ("x", "x_2020-02.parquet", 1),
    ]


def test_other_files_in_the_landing_directory_are_ignored(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    with open(f"{layers.landing('x')}/notes.txt", "w") as notes:
        notes.write("not data")
    assert values(landed_files(layers.spark, layers.landing("x"))) == [("x_2020-01.parquet",)]
    assert ingest(layers, X).rows == 1
    verify_bronze(layers, [X])


def test_absent_landing_directory_is_empty(layers):
    assert values(landed_files(layers.spark, layers.landing("x"))) == []
    assert ingest(layers, X) is None
    verify_bronze(layers, [X])


def test_rerun_with_nothing_new_commits_nothing(layers):
    land(layers, X, "x_2020-01.parquet", [1.0])
    ingest(layers, X)
    assert ingest(layers, X) is None
    assert layers.bronze("x").versions() == [0]


def test_crash_before_publishing_leaves_nothing_visible(layers, monkeypatch):
    land(layers, X, "x_2020-01.parquet", [1.0, 2.0])

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("tierline.sources.versioned.rename_new", crash)
        with pytest.raises(KeyboardInterrupt):
            ingest(layers, X)
    bronze = layers.bronze("x")
    assert not bronze.exists() and values(ingested_files(bronze)) == []
    assert ingest(layers, X).rows == 2
    assert bronze.versions() == [0] and bronze.read().count() == 2
    verify_bronze(layers, [X])


def test_second_writer_of_a_version_fails(layers):
    bronze = layers.bronze("x")
    rows = layers.spark.range(3).selectExpr("id as entity_code", "'x_2020-01.parquet' as source_file")
    bronze.append(rows, "first")
    with pytest.raises(Exception, match="already exists"):
        bronze.append(rows, "second", version=0)
    assert bronze.read().count() == 3


def test_history_records_every_commit(layers):
    assert layers.bronze("x").written_rows() == 0 and layers.bronze("x").last_version() == -1
    land(layers, X, "x_2020-01.parquet", [1.0])
    ingest(layers, X)
    land(layers, X, "x_2020-02.parquet", [1.0, 2.0])
    ingest(layers, X)
    bronze = layers.bronze("x")
    assert values(bronze.history(), "version", "operation", "rows") == [
        (0, "ingest x", 1),
        (1, "ingest x", 2),
    ]
    assert bronze.written_rows() == 2
    assert values(bronze.last_commit(), "version") == [(1,)]


def test_conform_without_a_table_changes_nothing(spark):
    df = spark.range(1)
    assert conform_to_table(df, None) is df


def test_read_before_the_first_commit_is_empty(layers):
    table = VersionedTable(layers.spark, f"{layers.root}/none", ("source_file",))
    assert table.read().count() == 0
    assert table.watermark() == -1
    assert raw_rows(X, [1.0]).num_rows == 1
