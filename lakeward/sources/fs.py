"""Small file-system helpers through Hadoop's FileSystem API (any scheme Spark can read)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return None if line is None else str(line)
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a one-line file that must not exist yet; False if another writer has it.

    The text is written under a name of its own and renamed to a name that is never
    reused, so a reader sees the whole file or none.
    """
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.exists(p):
        return False
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        return False
    return True


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.delete(p, True)
