"""Files that are made once: the next version of something, which only one of several writers can make."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system itself, so that no other failure to read passes for a missing file."""
    target, system = _file_system(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, system = _file_system(spark, path)
    system.delete(target, True)


def names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of what lies in a folder, but for hidden files; none if there is no folder."""
    target, system = _file_system(spark, folder)
    if not system.exists(target):
        return []
    found = [(status.getPath().getName(), status.getModificationTime()) for status in system.listStatus(target)]
    return sorted(each for each in found if not each[0].startswith("."))


def read(spark: SparkSession, path: str) -> str:
    target, system = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Makes a file with this content, whole; False if it is there already, even if two writers try at the same moment.

    The content is written beside it first. What takes its place must fail where the file exists: a hard link on a local or
    mounted disk, a rename on a file system such as HDFS, whose renames never replace a file.
    """
    target, system = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            here = system.resolvePath(target.getParent()).toUri().getPath()
            try:
                os.link(f"{here}/{draft.getName()}", f"{here}/{os.path.basename(urlparse(path).path)}")
            except FileExistsError:
                return False
            return True
        try:
            return bool(system.rename(draft, target))
        except Exception as error:
            if "AlreadyExists" in str(error):
                return False
            raise
    finally:
        system.delete(draft, False)
