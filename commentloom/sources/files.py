"""Small steps on the shared file system that a table needs around its writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all: written beside its place and renamed."""
    fs, target = file_system(spark, path)
    _, beside = file_system(spark, f"{path}.part")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; none if it is not there."""
    if not exists(spark, path):
        return None
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove_named(spark: SparkSession, root: str, prefix: str) -> int:
    """Remove the files below ``root`` whose name starts so; how many there were."""
    if not exists(spark, root):
        return 0
    fs, target = file_system(spark, root)
    files, gone = fs.listFiles(target, True), 0
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith(prefix):
            fs.delete(path, False)
            gone += 1
    return gone
