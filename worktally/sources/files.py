"""Small files and folders of any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """The sorted names in a folder; none if it isn't there."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def listing(spark: SparkSession, path: str) -> list[list]:
    """[path, size, time of change] of a file, or of the files of a folder and the folders in it."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    found, out = fs.listFiles(place, True), []
    while found.hasNext():
        one = found.next()
        out.append([one.getPath().toString(), one.getLen(), one.getModificationTime()])
    return out


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under another name and move it into place."""
    fs, place = _at(spark, path)
    fs.mkdirs(place.getParent())
    _, draft = _at(spark, path + "._writing")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(place, False)
    if not fs.rename(draft, place):
        raise OSError(f"could not move {path} into place")


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file; hidden ones, which a scan passes over, too."""
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all in it."""
    fs, place = _at(spark, path)
    fs.delete(place, True)
