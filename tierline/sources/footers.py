"""Row counts and schemas of Parquet files, read from their footers in tasks: a row per file, no data row.

Workers open files with Arrow's file systems. `workers_reach` tells whether they can open a store at all
(one small job per store and application); where they can't, callers count and infer with scans.
"""

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierline.sources.files import scheme, store_of

FOOTER = "n bigint, schema string"

# fixed values: Spark's type of a flat Parquet column, by physical type and annotation
SPARK_TYPES = {
    "BOOLEAN": {"None": "boolean"},
    "INT32": {
        "None": "integer", "Int(bitWidth=32, isSigned=true)": "integer", "Int(bitWidth=16, isSigned=true)": "short",
        "Int(bitWidth=8, isSigned=true)": "byte", "Int(bitWidth=8, isSigned=false)": "short",
        "Int(bitWidth=16, isSigned=false)": "integer", "Int(bitWidth=32, isSigned=false)": "long", "Date": "date",
    },
    "INT64": {
        "None": "long", "Int(bitWidth=64, isSigned=true)": "long",
        "Int(bitWidth=64, isSigned=false)": "decimal(20,0)",
        "Timestamp(isAdjustedToUTC=true, timeUnit=milliseconds)": "timestamp",
        "Timestamp(isAdjustedToUTC=true, timeUnit=microseconds)": "timestamp",
        "Timestamp(isAdjustedToUTC=false, timeUnit=milliseconds)": "timestamp_ntz",
        "Timestamp(isAdjustedToUTC=false, timeUnit=microseconds)": "timestamp_ntz",
    },
    "INT96": {"None": "timestamp"},
    "FLOAT": {"None": "float"},
    "DOUBLE": {"None": "double"},
    "BYTE_ARRAY": {"None": "binary", "String": "string", "Enum": "string", "JSON": "string"},
    "FIXED_LEN_BYTE_ARRAY": {"None": "binary"},
}


def with_footers(files: DataFrame) -> DataFrame:
    """`files` (with a `path`) with `n`, a file's rows, and `schema`, Spark's schema of it as JSON: the one that
    Spark wrote into it, else by its columns' types; NULL where a column isn't flat or of a type not listed."""
    kinds = SPARK_TYPES

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        import pyarrow.parquet as pq
        from pyarrow import fs

        opened: dict[str, fs.FileSystem] = {}

        def metadata(path: str) -> pq.FileMetaData:
            kind, _, rest = path.partition(":")
            if kind == "file":
                file_system, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                store = "/".join(path.split("/", 3)[:3])
                found, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                file_system = opened.setdefault(store, found)
            with file_system.open_input_file(name) as file:
                return pq.read_metadata(file)

        def schema_of(found: pq.FileMetaData) -> str | None:
            written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            if written is not None:
                return written.decode()
            fields = []
            for i in range(found.num_columns):
                column = found.schema.column(i)
                kind = str(column.logical_type).partition(", is_from")[0]
                kind = kind if kind.endswith(")") or "(" not in kind else kind + ")"
                named = kinds.get(column.physical_type, {}).get(kind)
                if kind.startswith("Decimal"):
                    named = f"decimal({column.precision},{column.scale})"
                if named is None or column.path != column.name or column.max_repetition_level:
                    return None
                fields.append({"name": column.name, "type": named, "nullable": True, "metadata": {}})
            return json.dumps({"type": "struct", "fields": fields})

        for batch in batches:
            found = [metadata(path) for path in batch.column("path").to_pylist()]
            columns = [
                pa.array([one.num_rows for one in found], pa.int64()),
                pa.array([schema_of(one) for one in found], pa.string()),
            ]
            yield pa.record_batch([*batch.columns, *columns], [*batch.schema.names, "n", "schema"])

    return files.mapInArrow(read, T.StructType([*files.schema.fields, *T.StructType.fromDDL(FOOTER).fields]))


_REACHED: dict[tuple[str, str], bool] = {}


def workers_reach(spark: SparkSession, path: str) -> bool:
    """Whether Python workers can open files of the store that holds `path`."""
    if scheme(spark, path) == "file":
        return True
    store = store_of(spark, path)
    key = (spark.sparkContext.applicationId, store)
    if key not in _REACHED:

        def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            for batch in batches:
                try:
                    fs.FileSystem.from_uri(store)
                    reached = True
                except (OSError, ValueError, pa.ArrowException):
                    reached = False
                yield pa.record_batch([pa.array([reached] * len(batch))], ["reached"])

        tried = spark.range(1).mapInArrow(attempt, "reached boolean")
        _REACHED[key] = tried.first()["reached"]
    return _REACHED[key]
