"""Session settings the tables depend on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Time text, calendar parts and the hashed timing keys all follow the session
# zone, so anything but UTC changes stored keys, not only what is displayed.
SESSION_ZONE = "UTC"

# A notice is packed to a tenth in files and costs far more to parse than to read,
# so a task gets as many as fit in its memory and keep all cores busy.
TASK_INPUT = "8m"
# Both results of the parse are open at once. Spark sorts what is left as soon as that many files
# are open; one more, without that sort, was measured and costs more CPU.
OPEN_FILES = 2
# Keys are digests and texts repeat within columns: files are what most of the disk goes to.
FILE_CODEC = "zstd"


def configure_session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Skewed joins (many notices with the same position) are split at run time.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", TASK_INPUT)
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    spark.conf.set("spark.sql.parquet.compression.codec", FILE_CODEC)
    return spark


# Longer methods, in bytes, are never compiled by the JVM but interpreted for every row. Long
# expressions without lambdas otherwise become one method of a stage.
SHORT_METHODS = {"spark.sql.codegen.hugeMethodLimit": 8000}


@contextmanager
def settings(spark: SparkSession, values: dict[str, int | str]) -> Iterator[None]:
    """Settings of the session for what is started meanwhile. A stream keeps those it was started with."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
