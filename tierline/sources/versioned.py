"""Append-only Parquet tables whose commits are numbered directories.

A table is `<path>/_commit_version=N/[<partition>=<value>/...]*.parquet`. A commit is written to
`<path>/_staging/<id>` by an ordinary Spark job, together with a one-row JSON record in `_commit`,
and made visible by renaming the directory. So a lost executor, a failed job or a dead driver
leaves at most an unpublished staging directory that no reader looks at, and a published version
always comes with its record. One writer per table; a second one fails on the rename.

The rename must be atomic, as it is on HDFS and POSIX file systems; other stores are refused unless
`any_store` is set. Staging directories of failed commits stay until `remove_staging` is called.
"""

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.expressions import max_source_version
from tierline.session import counting_session
from tierline.sources.files import child_names, remove, rename_new, scheme

VERSION_COLUMN = "_commit_version"
VERSION_FIELD = T.StructField(VERSION_COLUMN, T.LongType())
# Tasks move their own files into the staging directory, instead of the driver moving all of them
# one by one at the end. A half-finished job is harmless there: only the rename publishes.
TASK_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("source_version", T.LongType()),  # highest one; NULL without that column
    ]
)
TASK_ROWS = 250_000  # of a range layout: a task writes as many files as hold about so many rows
ATOMIC_RENAMES = {"file", "hdfs", "viewfs"}
SOURCE_VERSION = "_source_version"


class ReconciliationError(ValueError):
    """Two sides disagree on how many rows there are."""


@dataclass(frozen=True)
class Commit:
    """What one append added."""

    version: int
    rows: int
    operation: str = ""


class VersionedTable:
    """One append-only table. `contract` fixes the columns; without it the first commit does."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partitions: tuple[str, ...],
        contract: T.StructType | None = None,
        order: tuple[str, ...] = (),
        any_store: bool = False,
    ) -> None:
        self.spark = spark
        self.path = path
        self.partitions = partitions
        self.contract = contract
        self.order = order
        self.any_store = any_store

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        prefix = f"{VERSION_COLUMN}="
        names = child_names(self.spark, self.path)
        return sorted(int(name[len(prefix) :]) for name in names if name.startswith(prefix))

    def last_version(self) -> int:
        """Latest committed version, -1 when there is none."""
        return max(self.versions(), default=-1)

    def exists(self) -> bool:
        return self.last_version() >= 0

    def version_path(self, version: int) -> str:
        return f"{self.path}/{VERSION_COLUMN}={version}"

    def schema(self) -> T.StructType | None:
        """Columns of the table without the commit version, None before the first commit.

        Every append carries all columns the table has had, so one file of the newest commit shows
        them all and no reader has to merge the footers of older ones.
        """
        if self.contract is not None:
            return self.contract
        last = self.last_version()
        if last < 0:
            return None
        path = self.version_path(last)
        one = next(name for name in child_names(self.spark, path) if self._is_leading(name))
        return self.spark.read.option("basePath", path).parquet(f"{path}/{one}").schema

    def _is_leading(self, name: str) -> bool:
        return name.startswith(f"{self.partitions[0]}=")

    def read(self) -> DataFrame:
        """All rows, each with its `_commit_version`."""
        return self._scan(None)

    def read_inserts_since(self, start: int, ceiling: int | None = None) -> DataFrame:
        """Rows committed at versions start..ceiling, inclusive, tagged with that version.

        The tag is `_source_version`; it replaces the one the rows carry themselves. Only the
        directories of those versions are listed, so the cost follows the delta, not the table.
        """
        wanted = [v for v in self.versions() if v >= start and (ceiling is None or v <= ceiling)]
        return (
            self._scan([self.version_path(v) for v in wanted])
            .drop(SOURCE_VERSION)
            .withColumnRenamed(VERSION_COLUMN, SOURCE_VERSION)
        )

    def watermark(self, first_partition: str | None = None) -> int:
        """Highest `_source_version` held, -1 when empty; optionally of one leading partition.

        Appends only ever add higher source versions, so the newest commit that holds the
        partition is the only one that matters. Its record tells the version, unless the commit holds
        other partitions as well or its record is from before records did; then its rows do.
        """
        for version in reversed(self.versions()):
            path = self.version_path(version)
            alone = True
            if first_partition is not None:
                held = [unquote(name) for name in child_names(self.spark, path) if self._is_leading(name)]
                if f"{self.partitions[0]}={first_partition}" not in held:
                    continue
                alone = len(held) == 1
            recorded = self._records([version]).first()["source_version"] if alone else None
            if recorded is not None:
                return recorded
            newest = self._scan([path])
            if first_partition is not None:
                newest = newest.where(F.col(self.partitions[0]) == first_partition)
            return max_source_version(newest).first()["version"]
        return -1

    def listed_partitions(self, name: str) -> DataFrame:
        """Distinct values of a partition column, from a listing that Spark makes and keeps: nothing is read."""
        if not self.exists():
            return self.spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType())]))
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path)
        return files.select(F.col(name).cast("string").alias(name)).distinct()

    def append(
        self,
        df: DataFrame,
        operation: str,
        version: int | None = None,
        files: int | None = None,
        file_rows: int | None = None,
        expected: Callable[[], int] | None = None,
    ) -> Commit | None:
        """Publish `df` as the next version (or as `version`); None if it has no rows.

        Partition values are expected to be constant within an input file, so rows are written
        where they are read: no shuffle, and a hot partition is spread over all its input splits.

        With `files`, this commit is laid out in so many files of about equal size instead, each a range of
        `order`: one shuffle, after which few files hold any one period. A hot period spans several files.
        With `file_rows` too, a file's rows, a task writes several small files, one after another, so that tasks
        (each of which reports to the driver) follow the rows and not the files.
        With `expected`, the rows that the written files' footers tell must be as many, or nothing is published.
        """
        if not self.any_store and (store := scheme(self.spark, self.path)) not in ATOMIC_RENAMES:
            raise ValueError(
                f"renames on {store}: are not known to be atomic, so readers could see half a commit; "
                "any_store=True allows it"
            )
        number = self.last_version() + 1 if version is None else version
        staging = f"{self.path}/_staging/{uuid4().hex}"
        observed = Observation()
        has_source = SOURCE_VERSION in df.columns
        source = F.max(SOURCE_VERSION if has_source else F.lit(None).cast("bigint"))
        cuts = {}
        if files is not None and self.order:
            tasks = files if file_rows is None else -(-files // max(1, TASK_ROWS // file_rows))
            if tasks < files:
                cuts = {"maxRecordsPerFile": str(file_rows)}
            ranges = [*self.order, "_tie"]  # the tie cuts a period that is larger than a task's range
            df = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *ranges).drop("_tie")
        rows = df.observe(observed, F.count(F.lit(1)).alias("rows"), source.alias("source_version"))
        if self.order:  # within write tasks: row groups get narrow ranges, and nothing is shuffled
            rows = rows.sortWithinPartitions(*self.order)
        (
            rows.write.partitionBy(*self.partitions)
            .options(**TASK_COMMIT, **cuts)
            .parquet(staging)
        )
        rows = observed.get["rows"]
        if expected is not None and (found := self._staged_rows(staging)) != (wanted := expected()):
            remove(self.spark, staging)
            raise ReconciliationError(f"{operation}: {wanted} rows were read, {found} written; nothing is published")
        if rows == 0:
            remove(self.spark, staging)
            return None
        record = self.spark.range(1).select(
            F.lit(number).cast("bigint").alias("version"),
            F.lit(operation).alias("operation"),
            F.lit(rows).cast("bigint").alias("rows"),
            F.current_timestamp().alias("committed_at"),
            F.lit(observed.get["source_version"]).cast("bigint").alias("source_version"),
        )
        record.coalesce(1).write.json(f"{staging}/_commit")
        rename_new(self.spark, staging, self.version_path(number))
        return Commit(number, rows, operation)

    def _staged_rows(self, staging: str) -> int:
        """Rows of unpublished files, from their footers."""
        staged = VersionedTable(counting_session(self.spark), staging, self.partitions, self.contract)
        if not any(self._is_leading(name) for name in child_names(self.spark, staging)):
            return 0
        reader = staged.spark.read if self.contract is None else staged.spark.read.schema(self.contract)
        rows = reader.parquet(staging).groupBy(*self.partitions).agg(F.count(F.lit(1)).alias("rows"))
        return rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]

    def has_operation(self, operation: str) -> bool:
        """Whether a commit of that name was published."""
        return not self.history().where(F.col("operation") == operation).isEmpty()

    def recorded_rows(self, first: int, last: int) -> int:
        """Rows of the commits first..last, from their records."""
        records = self._records([v for v in self.versions() if first <= v <= last])
        return records.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]

    def remove_staging(self) -> int:
        """Delete what failed commits left behind; how many there were. Call it while nothing writes."""
        staging = f"{self.path}/_staging"
        left = len(child_names(self.spark, staging))
        remove(self.spark, staging)
        return left

    def history(self) -> DataFrame:
        """One row per commit: version, operation, rows, committed_at, source_version."""
        return self._records(self.versions())

    def _records(self, versions: list[int]) -> DataFrame:
        records = [f"{self.version_path(v)}/_commit" for v in versions]
        if not records:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(records)

    def counts(self, beside: SparkSession) -> DataFrame:
        """Rows per combination of all partition columns and the commit version, as `rows`.

        Read in a counting session, every file's count comes from its footer. Spark does that only if all
        partition columns are grouping keys.
        """
        same = VersionedTable(beside, self.path, self.partitions, self.contract)
        keys = [VERSION_COLUMN, *self.partitions]
        return same.read().groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))

    def last_commit(self) -> DataFrame:
        """The newest row of the history, found by sorting as a user of the history would."""
        return self.history().orderBy(F.desc("version")).limit(1)

    def written_rows(self) -> int:
        """Rows the latest commit added, from its record; 0 without one."""
        last = self.last_commit().first()
        return 0 if last is None or last["rows"] is None else last["rows"]

    def _scan(self, paths: list[str] | None) -> DataFrame:
        schema = self.schema()
        if schema is None:  # nothing committed yet: only the partition columns are known
            schema = T.StructType([T.StructField(name, T.StringType()) for name in self.partitions])
        with_version = T.StructType([*schema.fields, VERSION_FIELD])
        if paths == [] or not self.exists():
            return self.spark.createDataFrame([], with_version)
        reader = self.spark.read.schema(with_version).option("basePath", self.path)
        return reader.parquet(*([self.path] if paths is None else paths))
