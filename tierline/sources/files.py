"""The few directory operations Spark's readers and writers do not cover.

They go through Hadoop's file system classes, so any store Spark can reach works. All of them
touch directory entries only, never file contents. They need a classic session: a Spark Connect client
has no access to those classes.
"""

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds `path`, and the path on it."""
    if getattr(spark, "_jvm", None) is None:
        raise RuntimeError("directories are listed and renamed through the driver's JVM: use a classic session")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system, file_system.makeQualified(target)


def child_names(spark: SparkSession, directory: str) -> list[str]:
    """Names directly under `directory`, sorted; empty if it does not exist."""
    file_system, path = _resolve(spark, directory)
    if not file_system.exists(path):
        return []
    # put together in the JVM, so that a listing is one call however many entries it has: {a/x,a/y,...},
    # where only the directory itself can follow a comma with slashes in it
    hadoop, lang = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.commons.lang3
    text = lang.ArrayUtils.toString(hadoop.FileUtil.stat2Paths(file_system.listStatus(path)))[1:-1]
    start = path.toString().rstrip("/") + "/"
    names = sorted(text.removeprefix(start).split("," + start)) if text else []
    if any("/" in name for name in names):
        raise RuntimeError(f"entries of {directory} are not listed below {start}: {names[:3]}")
    return names


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _resolve(spark, path)
    return bool(file_system.exists(target))


def store_of(spark: SparkSession, path: str) -> str:
    """The root of the file system that holds `path`, as a URI."""
    return str(_resolve(spark, path)[0].getUri().toString()).rstrip("/") + "/"


def scheme(spark: SparkSession, path: str) -> str:
    """The scheme of the file system that holds `path`."""
    return str(_resolve(spark, path)[0].getUri().getScheme())


def reported_paths(spark: SparkSession, directory: str) -> list[str]:
    """The ways Spark's file metadata columns may write a directory: absolute, URI-encoded.

    Without a host, both `file:/x` and `file:///x` occur, depending on how files were listed.
    """
    _, path = _resolve(spark, directory)
    uri = path.toUri()
    host = uri.getRawAuthority()
    full = f"{uri.getScheme()}://{host or ''}{uri.getRawPath()}"
    return [full] if host else [full, f"{uri.getScheme()}:{uri.getRawPath()}"]


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename `source` to `target`, failing if `target` exists.

    FileContext is used because FileSystem.rename moves the source *into* an existing directory.
    """
    file_system, path = _resolve(spark, source)
    _, destination = _resolve(spark, target)
    file_system.mkdirs(destination.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(
        file_system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    no_overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context.rename(path, destination, no_overwrite)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename `source` to a `target` known not to exist."""
    file_system, path = _resolve(spark, source)
    _, destination = _resolve(spark, target)
    file_system.mkdirs(destination.getParent())
    if not file_system.rename(path, destination):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, directory: str) -> None:
    """Delete a directory this library created and never published."""
    file_system, path = _resolve(spark, directory)
    file_system.delete(path, True)


def remove_at_exit(spark: SparkSession, directory: str) -> None:
    """Ask the file system to delete a scratch directory when the session's JVM ends."""
    file_system, path = _resolve(spark, directory)
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
