"""Sends this package to the executors, and names folders that they share with the driver."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, once for each Spark application.

    Functions of the Python stages are pickled by name; without this, a worker that wasn't started in this
    package's own folder can't find them.
    """
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_epochal_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="epochal-")) / f"{root.name}.zip"  # the driver's own: Spark sends it on
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._epochal_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a local session without that setting gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="epochal-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
