"""Session-level helpers: shipping the package to executors, and the folder that all of them share."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


_BATCH, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 4 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor (once per application).

    Arrow batches are bounded by bytes, unless the session has a bound of its own: the default holds many long texts, in
    the executor's buffers and again in Python.
    """
    if spark.conf.get(_BATCH, str(_BATCH_DEFAULT)).rstrip("b") == str(_BATCH_DEFAULT):
        spark.conf.set(_BATCH, str(_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()
    path = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(path)
    atexit.register(shutil.rmtree, folder, True)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The URI of the folder in ``spark.checkpoint.dir``; a private one is set only where that is unset (local runs)."""
    sc = spark.sparkContext
    uri = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if uri is None and current is not None:
        uri = os.path.dirname(current.rstrip("/"))
    if uri is None:
        folder = tempfile.mkdtemp(prefix="blockflow-shared-")
        atexit.register(shutil.rmtree, folder, True)
        uri = f"file://{folder}"
    if current is None:
        sc.setCheckpointDir(uri)
    return uri.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/blockflow/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    if folders is not None:
        folders.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Free the files of shuffles that nothing refers to any more: Spark does so when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, whatever file system holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
