"""Folders for stored layers, checkpoints and stream outputs."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Where it names none, that of the tables, which all executors reach as well.
    """
    return (spark.conf.get(SHARED_DIR, None) or spark.conf.get(WAREHOUSE_DIR)).rstrip("/")


def new_folder(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A path nothing else writes to, below ``root`` or the shared folder."""
    return f"{root or shared_dir(spark)}/flarebook/{purpose}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed."""
    files, place = _files(spark, path)
    return files.getFileStatus(place).getModificationTime()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, in order."""
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    files, place = _files(spark, path)
    return files.getContentSummary(place).getLength()


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small file of lines, which is there as a whole or not at all."""
    files, place = _files(spark, path)
    begun = place.suffix(".begun")
    files.delete(place, False)
    out = files.create(begun, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()
    if not files.rename(begun, place):
        raise OSError(f"{path} could not be written")


def read_lines(spark: SparkSession, path: str) -> list[str] | None:
    """The lines of a small file; None if there is none."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return text.split("\n") if text else []
