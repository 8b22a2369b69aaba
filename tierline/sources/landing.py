"""Landed Parquet files: listing, schema-drift-tolerant reading, row counts.

A landing directory holds entries named `<anything>YYYY-MM<anything>.parquet`. An entry is one
Parquet file or a directory of part files (how Spark itself writes a big one). Its name is the
`source_file` of every row in it.
"""

import json
from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.files import child_names, exists, reported_paths
from tierline.sources.footers import with_footers, workers_reach

MAX_LENGTH = 2**31 - 1  # "to the end" for substring
UNMERGEABLE = "CANNOT_MERGE_SCHEMAS"  # condition of the error for types that have no common one


def name_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    """A local one-column frame of file names (one per file, so small by nature)."""
    return spark.createDataFrame(pa.table({"source_file": pa.array(names, pa.string())}))


def landed_parts(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Every landed Parquet file: path, length and source_file, the entry it belongs to.

    Spark lists the directory (in tasks, if it is a large one) when this is called; the names stay in Spark.
    Later use of the frame sees the same listing. A directory is an entry once it holds a file.
    """
    if not exists(spark, landing_dir):
        return spark.createDataFrame([], "path string, length bigint, source_file string")
    found = (
        spark.read.format("binaryFile")  # a row per file; contents are read only if asked for
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(landing_dir)
    )
    entry = entry_name(spark, F.col("_metadata.file_path"), landing_dir).alias("source_file")
    return found.select("path", "length", entry).where(F.col("source_file").endswith(".parquet"))


def landed_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Names of the Parquet entries in a landing directory; none if it does not exist."""
    return landed_parts(spark, landing_dir).select("source_file").distinct()


def entry_name(
    spark: SparkSession, path: Column, landing_dir: str, file_name: Column | None = None
) -> Column:
    """Landing entry that a file path reported by Spark belongs to: the segment after the directory.

    It runs once per scanned row, so it avoids searching the path. With the file's own name given,
    an entry that is a single file costs two comparisons. For a directory entry the segment is cut
    out as bytes, since cutting text counts its characters (a URI is ASCII, so both agree).
    """
    name = F.raise_error(F.concat(F.lit(f"not under {landing_dir}: "), path))
    for directory in reported_paths(spark, landing_dir):
        start = directory.rstrip("/") + "/"
        rest = F.substring(path.cast("binary"), len(start) + 1, MAX_LENGTH).cast("string")
        segment = F.substring_index(rest, "/", 1)
        if file_name is not None:
            is_file = F.octet_length(path) == F.octet_length(file_name) + len(start)
            segment = F.when(is_file, file_name).otherwise(segment)
        name = F.when(path.startswith(start), segment).otherwise(name)
    # '+' is not escaped in a URI, but decoding would change it
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), decoded).otherwise(name)


def read_clean(
    spark: SparkSession, landing_dir: str, names: list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Read entries in one scan, lowercase the columns and add `source_file`.

    With a schema, files may lack columns of it, which are NULL; without one, all must have the same.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.parquet(*[f"{landing_dir}/{name}" for name in names])
    path, file_name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    tagged = raw.withColumn("source_file", entry_name(spark, path, landing_dir, file_name))
    return tagged.toDF(*[name.lower() for name in tagged.columns])


Groups = list[tuple[list[str], T.StructType]]


def schema_groups(spark: SparkSession, landing_dir: str, parts: DataFrame) -> Groups:
    """The landed files in groups that one scan can read, each with its merged schema. Files without rows are
    left out.

    Footers are read once, in tasks. The driver gets each distinct schema, and the names to be read: an
    entry whose files agree by its own name, one whose parts differ by theirs.
    """
    if not workers_reach(spark, landing_dir):
        names = parts.select("source_file").distinct().orderBy("source_file").toArrow()
        return merged_by_trial(spark, landing_dir, names.column("source_file").to_pylist()) if len(names) else []
    shape = F.coalesce(F.xxhash64("schema"), F.lit(0)).alias("shape")
    read = with_footers(parts).select("source_file", "path", "n", "schema", shape).persist()
    try:
        per_entry = read.groupBy("source_file").agg(
            F.sum("n").alias("rows"),
            F.min("shape").alias("shape"),
            F.max("shape").alias("other"),
            F.min("path").alias("path"),
        )
        entries = per_entry.where("rows > 0").toArrow().sort_by("source_file")
        same = pc.equal(entries.column("shape"), entries.column("other"))
        found = [entries.filter(same).select(["source_file", "shape", "path"])]
        if not pc.all(same).as_py():  # parts are named below their entry
            mixed = per_entry.where("rows > 0 and shape <> other").select("source_file")
            name = F.concat_ws("/", "source_file", F.substring_index("path", "/", -1)).alias("source_file")
            part = read.where("n > 0").join(mixed, "source_file").select(name, "shape", "path")
            found.append(part.toArrow().sort_by("source_file"))
        wanted = pa.concat_tables([one.cast(found[0].schema) for one in found])
        names, shapes, paths = (wanted.column(i).to_pylist() for i in range(3))
        examples = dict(zip(shapes, paths, strict=True))  # a file of each schema
        rows = read.where(F.col("path").isin(list(examples.values()))).select("shape", "schema").collect()
        known = {row["shape"]: row["schema"] for row in rows}
    finally:
        read.unpersist()
    by_shape: dict[int, list[str]] = {}
    for name, number in zip(names, shapes, strict=True):
        by_shape.setdefault(number, []).append(name)
    groups: list[tuple[list[str], dict[str, T.StructField]]] = []
    for number, members in by_shape.items():
        if known[number] is None:  # a type that only Spark knows; such files may differ among themselves
            return merged_by_trial(spark, landing_dir, names)
        fields = {field.name.lower(): field for field in T.StructType.fromJson(json.loads(known[number]))}
        _join_group(groups, members, fields)
    return [(members, T.StructType(list(fields.values()))) for members, fields in groups]


def _join_group(
    groups: list[tuple[list[str], dict[str, T.StructField]]], names: list[str], fields: dict[str, T.StructField]
) -> None:
    """Add files to the first group whose shared columns have their types, or open a new one."""
    for members, merged in groups:
        if all(merged[name].dataType == field.dataType for name, field in fields.items() if name in merged):
            members.extend(names)
            merged.update({name: field for name, field in fields.items() if name not in merged})
            return
    groups.append((list(names), dict(fields)))


def merged_schemas(spark: SparkSession, landing_dir: str, names: list[str]) -> Groups:
    """The named entries in groups that one scan can read, each with its merged schema."""
    return schema_groups(spark, landing_dir, _named_parts(spark, landing_dir, names))


def _named_parts(spark: SparkSession, landing_dir: str, names: list[str]) -> DataFrame:
    return landed_parts(spark, landing_dir).join(name_frame(spark, names), "source_file", "left_semi")


def merged_by_trial(spark: SparkSession, landing_dir: str, names: list[str]) -> Groups:
    """The same for stores that Python workers can't open, and types that only Spark knows.

    Spark reads the footers of a group, every part of its directories included, in one job. A group with
    types that do not merge (integers of different width, say) is halved and tried again, so the jobs
    follow the number of such changes among the sorted names, not the number of files.
    """
    reader = spark.read.option("mergeSchema", True)
    try:
        return [(names, reader.parquet(*[f"{landing_dir}/{name}" for name in names]).schema)]
    except (PySparkException, Py4JJavaError) as error:  # raised inside a task, it comes unconverted
        if UNMERGEABLE not in str(error):
            raise
        if len(names) == 1:
            files = [file for file in child_names(spark, f"{landing_dir}/{names[0]}") if file[0] not in "_."]
            if len(files) < 2:
                raise
            names = [f"{names[0]}/{file}" for file in files]  # a directory whose parts differ
    half = len(names) // 2
    return merged_by_trial(spark, landing_dir, names[:half]) + merged_by_trial(spark, landing_dir, names[half:])


def read_parts(spark: SparkSession, landing_dir: str, parts: DataFrame) -> DataFrame | None:
    """Union the files by column name; absent columns become NULL, types are widened. None without any row.

    The plan has a scan per distinct set of types, not one per file.
    """
    groups: dict[frozenset[tuple[str, str]], tuple[list[str], T.StructType]] = {}
    for names, schema in schema_groups(spark, landing_dir, parts):
        key = frozenset((field.name.lower(), field.dataType.json()) for field in schema)
        groups.setdefault(key, ([], schema))[0].extend(names)
    if not groups:
        return None
    scans = [read_clean(spark, landing_dir, names, schema) for names, schema in groups.values()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), scans)


def read_new_files(spark: SparkSession, landing_dir: str, names: list[str]) -> DataFrame | None:
    """The same for entries by name."""
    return read_parts(spark, landing_dir, _named_parts(spark, landing_dir, names))


def landing_counts(
    spark: SparkSession,
    landing_dirs: Mapping[str, str],
    listed: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of every landed entry of the feeds (feed -> directory), 0 for an empty entry.

    `listed` are the files to count (feed -> landed_parts), by default those there are now. Counts are the
    footers', a row per file. Other folders below a landing directory are not entries.
    """
    parts = {feed: (listed or {}).get(feed) for feed in landing_dirs}
    parts = {feed: landed_parts(spark, landing_dirs[feed]) if df is None else df for feed, df in parts.items()}
    counts = {}
    for feed, files in parts.items():
        if workers_reach(spark, landing_dirs[feed]):
            counts[feed] = with_footers(files.select("source_file", "path")).select("source_file", "n")
        else:
            counts[feed] = scanned_counts(spark, landing_dirs[feed], files)
    rows = stack_feeds(counts).groupBy("feed", "source_file")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("landing_rows"))


def scanned_counts(spark: SparkSession, landing_dir: str, files: DataFrame) -> DataFrame:
    """Rows of every file (source_file, n), for stores that Python workers can't open.

    The scan asks for no column. Rows are counted by a number that stands for their file's path; names
    are made from the listing with a row per file.
    """
    path = F.xxhash64("path").alias("file")
    names = files.select("source_file", path)
    if not exists(spark, landing_dir):
        return names.select("source_file", F.lit(0).cast("bigint").alias("n"))
    scan = (
        spark.read.schema(T.StructType([]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(landing_dir)
    )
    # the listing writes a path as it is, the scan as a URI
    uri = F.col("_metadata.file_path")
    plain = F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)
    plain = F.regexp_replace(plain, "^file:/+", "file:/")
    rows = scan.select(F.xxhash64(plain).alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return names.join(rows, "file", "left").select("source_file", F.coalesce("n", F.lit(0)).alias("n"))


def stack_feeds(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Union of per-feed frames by position, labelled with the feed. Aggregating the union takes
    one shuffle, not one per feed."""
    labelled = [df.select(F.lit(feed).alias("feed"), "*") for feed, df in frames.items()]
    return reduce(DataFrame.union, labelled)
