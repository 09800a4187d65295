"""What a session needs before Python code of this package runs on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application, for workers that have it on no path of their own.

    The archive is written on the driver and served by the driver; executors need no shared folder for it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="docrel-")) / "docrel_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))


def work_folder(spark: SparkSession) -> str:
    """The folder that the driver and executors share, from ``spark.checkpoint.dir``; a local session may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="docrel-work-")
