"""Folders and small files through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as one of its own."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = file_system(spark, path)
    fs.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = file_system(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Give a whole file its final name unless that name is taken; whoever comes second
    gets False. A rename that refuses to overwrite decides it; on a local disk, where
    renames overwrite, a hard link does."""
    fs, start = file_system(spark, source)
    end = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.getUri().getScheme() == "file":
        local = lambda p: spark._jvm.java.nio.file.Paths.get(p.toUri().getPath(), _strings(spark))
        move = lambda: spark._jvm.java.nio.file.Files.createLink(local(end), local(start))
    else:
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark._jsc.hadoopConfiguration()
        )
        never = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        move = lambda: context.rename(start, end, never)
    try:
        move()
        return True
    except Exception:
        if fs.exists(end):
            return False
        raise
    finally:
        fs.delete(start, False)


def _strings(spark: SparkSession):
    return spark._sc._gateway.new_array(spark._jvm.java.lang.String, 0)
