"""Session helpers: shared scratch folder, materialised stages, package shipping."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder is lost with its
    machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if folder.startswith("file:") and not context.master.startswith("local"):
            warnings.warn(f"spark.checkpoint.dir is {folder}: every machine must mount it", stacklevel=2)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rowloom-")
    context.setCheckpointDir(folder)
    return shared_dir(spark)


def new_path(spark: SparkSession, label: str) -> str:
    """Return an unused path below the shared folder."""
    return f"{shared_dir(spark)}/rowloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cuts the lineage with a result that outlives lost executors.  Unlike
    ``checkpoint()`` the copy is columnar, so each later use reads only the
    columns and row groups it needs.  Row order is not kept.  The copy stays
    until ``release`` is called with the result, or until the ``stages`` block
    around the call ends.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    if _open_stages:
        _open_stages[0].append((spark, path))
    stored = spark.read.schema(df.schema).parquet(path)
    stored._rowloom_path = path
    return stored


#: The folders written inside the ``stages`` blocks that are open, the innermost first.
_open_stages: list[list[tuple[SparkSession, str]]] = []


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(stored: DataFrame) -> None:
    """Remove the copy behind a result of ``materialize``; other frames are left alone."""
    path = getattr(stored, "_rowloom_path", None)
    if path:
        _delete(stored.sparkSession, path)


@contextmanager
def stages() -> Iterator[None]:
    """Remove on leaving what operators have written to the shared folder inside the block.

    Results must have been written or collected by then.
    """
    held: list[tuple[SparkSession, str]] = []
    _open_stages.insert(0, held)
    try:
        yield
    finally:
        _open_stages.remove(held)
        for spark, path in held:
            _delete(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of ``spark``.

    Needed once per application when the package is not installed on the
    executors.  Spark distributes the archive itself.
    """
    context = spark.sparkContext
    if getattr(context, "_rowloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rowloom-"), "rowloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._rowloom_shipped = True
