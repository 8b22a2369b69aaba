"""Run queries on Spark and DuckDB and compare them as sorted multisets.

    python tests/oracle_check.py [sf_dir] [name prefix ...]
"""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("lineitem", "orders", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _canonical(rows: list[tuple], names: list[str]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


# Spark type of each DuckDB type a query may return
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def difference(spark_rows: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    names, got = _canonical([tuple(row) for row in spark_rows.collect()], spark_rows.columns)
    result = connection.execute(sql)
    wanted_names, wanted = _canonical(result.fetchall(), [column[0] for column in result.description])
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    wanted_types = {column[0]: TYPES.get(str(column[1]), str(column[1])) for column in result.description}
    if dict(spark_rows.dtypes) != wanted_types:
        return f"types {dict(spark_rows.dtypes)} != {wanted_types}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for ours, theirs in zip(got, wanted, strict=True):
        if ours != theirs:
            return f"{ours} != {theirs}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracle = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            problem = difference(query(spark, sf_dir), connection, oracle[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{bad} differing")


if __name__ == "__main__":
    main()
