"""Folders: whether they are there, moving them, and scratch space on the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder `new` in the place of `path`. Both lie on one file system."""
    place, files = _place(spark, path)
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(_place(spark, new)[0], place):
        raise OSError(f"{new} could not be moved to {path}")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address under `spark.checkpoint.dir`, gone when the application ends; nothing is made yet.

    Only a session on one machine may lack the setting; it uses that machine's temporary folder.
    """
    shared = spark.conf.get(SETTING, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="scratch-")
    folder = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place, files = _place(spark, folder)
    files.deleteOnExit(place)
    return folder
