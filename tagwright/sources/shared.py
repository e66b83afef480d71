"""Where intermediate tables go, and when they are removed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_open: list[list[str]] = []


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "executors need a folder that all of them share: set spark.checkpoint.dir "
            "or SparkContext.setCheckpointDir"
        )
    folder = tempfile.mkdtemp(prefix="tagwright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the folder that all executors share.

    That is ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given. Where neither is set, a
    single machine uses a local temporary folder, which goes when Python ends; a cluster raises an
    error, as its executors would write to disks of their own.
    """
    folder = f"{_base(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(folder)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders made inside the block when it ends.

    DataFrames are lazy: use or write what is built inside before the end.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for folder in made:
            remove_folder(spark, folder)
