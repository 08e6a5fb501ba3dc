"""What a job shares with its executors: a folder to write to, and this package."""

from __future__ import annotations

import pathlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: With it Spark deletes the shuffle files of a job as the job ends, not when the driver happens to collect its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a fresh temporary one only where one machine is all there is."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="farsight-")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A folder under the shared one that no other run uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a job in here goes from the disks as soon as the job is done."""
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_SETTING) if before is None else spark.conf.set(CLEANUP_SETTING, before)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, where it is not installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='farsight-package-')}/{package.name}",
        "zip",
        root_dir=package.parent,
        base_dir=package.name,
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
