"""Sessions for the engine, and shipping the package to workers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(name: str = "riskflow", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; sizes are left to the cluster's own settings.

    Unions don't claim a partitioning: with it, this Spark version can plan a chain of merges over sides of different
    partition counts and fail.
    """
    builder = SparkSession.builder.appName(name)
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.unionOutputPartitioning": "false", **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a temporary one where none is set and all of Spark runs
    on this machine. Elsewhere executors would write to their own disks, so that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='riskflow-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Makes the package importable in Python workers, once for each application. Rows may hold long texts, so Arrow batches are
    kept small unless the session has a size of its own."""
    app = spark.sparkContext.applicationId
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, "2000")
    if app in _shipped:
        return
    root = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(), "riskflow_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path(root.name, file.relative_to(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
