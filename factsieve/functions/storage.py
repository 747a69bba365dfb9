"""Shared storage: where lineage is cut and intermediate tables live."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: spark.checkpoint.dir, or a fresh local one where a local session names none.

    On a cluster a machine's own folder can't be read by the others, so a session there must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="factsieve-")
        spark.conf.set("spark.checkpoint.dir", named)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def materialize(df: DataFrame, label: str = "t", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the result survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, whatever file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, whatever file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once an application; executors needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_factsieve_shipped", False):
        return
    folder = shared_dir(spark)
    local = folder[len("file:") :].replace("//", "/", 1) if folder.startswith("file:") else folder if folder.startswith("/") else tempfile.mkdtemp(prefix="factsieve-")
    os.makedirs(local, exist_ok=True)
    target = os.path.join(local, f"factsieve-{uuid.uuid4().hex}.zip")
    root = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(target)
    context._factsieve_shipped = True
