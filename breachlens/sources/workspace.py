"""Shared folder for intermediate layers, and the package for Python workers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting, it lies beside the tables in the warehouse, which driver and executors
    share as well.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/breachlens/{context.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, as ``spark-submit --py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="breachlens-")
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def folder_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
