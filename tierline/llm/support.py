"""What several of the operators need: a shared folder, cut lineage, checked broadcasts, row groups, row numbers."""

import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.sources.files import remove, remove_at_exit

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# what has been written on the way to the result of `settled`
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the session names it.

    Where the cluster names none, a temporary folder serves if everything runs in one process.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = f"{tempfile.gettempdir()}/tierline-llm"
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, application_id: str | None = None) -> str:
    """Where an application (this one, if none is named) keeps what it has written, in the shared folder."""
    return f"{shared_folder(spark)}/llm-{application_id or spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again, which cuts its lineage.

    The files outlive lost executors. They go when the session ends, or earlier by `settled`; after a driver
    that was killed, `remove_written` removes them.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark)
    path = f"{folder}/{name}-{uuid4().hex}"
    remove_at_exit(spark, folder)
    df.write.mode("overwrite").parquet(path)
    paths = _on_the_way.get()
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `make` gives, `written`; then all that was written on the way to it is removed.

    `make` must hand out no other frames. A `settled` frame that it reads is removed with the rest.
    """
    paths: list[str] = []
    token = _on_the_way.set(paths)
    try:
        result = written(make(), name)
    finally:
        _on_the_way.reset(token)
    outer = _on_the_way.get()
    if outer is not None:
        outer.append(paths[-1])
    for path in paths[:-1]:
        remove(spark, path)
    return result


def remove_written(spark: SparkSession, application_id: str | None = None) -> None:
    """Remove all that an application has written: this one, or one whose driver is dead."""
    remove(spark, scratch_folder(spark, application_id))


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame | None:
    """`df` hinted for broadcasting if it has at most `most_rows` rows, else None.

    Counting stops just above the bound. `df` should be written or otherwise cheap to read twice.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else None


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(key: Column, text: Column) -> tuple[Column, Column]:
    """Two halves of 128 bits of the SHA-256 of a row's id and text: equal for rows equal in both only."""
    name = key.cast("string")
    marked = F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    digest = F.sha2(F.concat(marked, F.lit(" "), text), 256)
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint") for at in (1, 17))


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each key from batches that are sorted by it, a run of whole keys at a time.

    A run holds every complete key of one or more batches, so a table yielded has many small keys
    or one large one, and never part of a key. `keys` must not hold NULLs.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        starts = run_starts([batch.column(key) for key in keys])
        if held:
            same = all(batch.column(k)[0].as_py() == held[-1].column(k)[-1].as_py() for k in keys)
            if same and len(starts) == 1:
                held.append(batch)
                continue
        elif len(starts) == 1:
            held = [batch]
            continue
        last = int(starts[-1])
        yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def run_starts(columns: list[pa.Array]) -> np.ndarray:
    """Positions at which the key formed by `columns` changes, 0 first."""
    size = len(columns[0])
    changes = np.zeros(size, bool)
    changes[:1] = True
    for column in columns:
        values = column.to_numpy(zero_copy_only=False)
        changes[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changes)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and where each row starts (and the last ends).

    NULL counts as empty. Nothing is copied for a column without NULLs.
    """
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    size = len(column)
    starts = np.frombuffer(offsets, kind, size + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """`df` with `place`, a row's number from 0 within its group in the order of `order`, and `size`, the
    rows of its group.

    Rows are sorted by ranges of group and order and written; a row's number is its place in its task's
    part of the group after the rows of earlier parts. So a group of any size is spread over many tasks,
    and so are rows equal in every column, whose order is arbitrary. `df` is read twice (for the ranges,
    then to be sorted) and must give the same rows in the same order both times, as a written table does.
    """
    keys = [*groups, *order, "_tie"]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    rows = ranged.sortWithinPartitions(*keys).drop("_tie")
    rows = written(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", inside), name)
    # a row per group and task
    parts = rows.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("rows"), F.min("_at").alias("first"))
    group = Window.partitionBy(*groups)
    before = F.sum("rows").over(group.orderBy("_part")) - F.col("rows")
    parts = parts.select(
        *[F.col(key).alias(f"_{key}") for key in groups],
        F.col("_part").alias("_of"),
        (before - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("size"),
    )
    same = F.col("_part") == F.col("_of")
    for key in groups:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    joined = rows.join(parts, same)
    return joined.select(*df.columns, (F.col("_at") + F.col("shift")).alias("place"), "size")


def running_sums(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """`df` with `before_<column>` for each of `sums`: the column's sum over all rows that come earlier in the
    order of `order`, which must tell rows apart.

    Rows are sorted by ranges and written; a row's sum is that of its range so far after the sums of earlier
    ranges, of which there is a row each. `df` is read twice, as `numbered` reads it.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(ranged.withColumn("_part", F.spark_partition_id()), name)
    parts = rows.groupBy(F.col("_part").alias("_of")).agg(*[F.sum(key).alias(f"_{key}") for key in sums])
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_of", *[F.coalesce(F.sum(f"_{key}").over(earlier), F.lit(0)).alias(f"_{key}") for key in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = {f"before_{key}": F.coalesce(F.sum(key).over(inside), F.lit(0)) for key in sums}
    joined = rows.withColumns(own).join(parts, F.col("_part") == F.col("_of"))
    return joined.select(*df.columns, *[(F.col(f"before_{key}") + F.col(f"_{key}")).alias(f"before_{key}") for key in sums])
