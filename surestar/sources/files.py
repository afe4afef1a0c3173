"""Path helpers on whatever file system the path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join_path(*parts: str) -> str:
    return "/".join(part.rstrip("/") for part in parts)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, or ``None`` if there is none."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over an earlier one.

    Without the checksum file that local disks get, so that a file changed by hand can still be read. That is a setting of the whole file
    system, so the file gets an instance of its own.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(hadoop_path.getFileSystem(conf).getUri(), conf)
    try:
        fs.setWriteChecksum(False)
        stream = fs.create(hadoop_path, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
    finally:
        fs.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if the path does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory())
