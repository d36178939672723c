"""Folders for what a run writes on the way."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.gettempdir()
    folder = f"{shared.rstrip('/')}/oreflow-{label}-{uuid.uuid4().hex}"
    # What a query returns may be read long after the call, so its folder stays until the end.
    atexit.register(remove_folder, spark, folder)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of this process; a JVM that is gone already leaves it in place."""
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(place, True)
    except (Py4JError, OSError):
        pass
