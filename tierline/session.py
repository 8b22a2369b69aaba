"""Session settings the layers rely on."""

from pyspark.sql import SparkSession

REQUIRED = {
    # times are stored as UTC instants, so the zone is part of the table contract
    "spark.sql.session.timeZone": "UTC",
    # file schemas are grouped and read without regard to the case of column names
    "spark.sql.caseSensitive": "false",
    # casts must fail loudly on overflow
    "spark.sql.ansi.enabled": "true",
    # a task's input spans few periods: keep their writers open instead of sorting its rows
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def get_session(app: str = "tierline", **conf: str) -> SparkSession:
    """The active session (or a new one) with the required settings applied.

    Extra settings come as keyword arguments with dots written as double underscores, e.g.
    `spark__sql__shuffle__partitions="8"`. They only take effect on a session created here.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return require_settings(builder.getOrCreate())


def require_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings in REQUIRED to a session made elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


# Parquet as a source whose counts Spark answers from file footers, one row per file
COUNTING = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


_BESIDE: dict[str, SparkSession] = {}  # by application


def counting_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark` for counts by partition columns; `spark` keeps its own settings.

    An application has one, made when it is first asked for.
    """
    application = spark.sparkContext.applicationId
    if application not in _BESIDE:
        _BESIDE[application] = spark.newSession()
        for key, value in (REQUIRED | COUNTING).items():
            _BESIDE[application].conf.set(key, value)
    return _BESIDE[application]
