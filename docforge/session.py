"""What a session needs for functions that run in Python on executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared one (``spark.checkpoint.dir``); a temporary one only on a single machine."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    base = known.get() if known.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docforge-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A shared folder for tables that nothing returned reads; deleted at the end, also after an error."""
    folder = shared_folder(spark, name)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per context, as they may not have it on their path."""
    sc = spark.sparkContext
    if not getattr(sc, "_docforge_shipped", False):
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='docforge-')}/docforge", "zip", root.parent, root.name)
        sc.addPyFile(archive)
        sc._docforge_shipped = True
