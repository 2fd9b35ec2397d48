"""Sessions with the settings the plans expect."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """UTC, adaptive plans and Arrow transfer; everything else by ``conf``."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for key, value in {"spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to a number of tasks that adaptive plans don't lower: for work that takes long for its bytes."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """This package for the executors' Python, once an application, wherever the driver has it from."""
    context = spark.sparkContext
    home = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not home.is_dir():  # not a folder: it came here by this very way
        return
    _shipped.add(context.applicationId)
    path = Path(tempfile.mkdtemp(), "quire.zip")  # served from here as long as the application runs
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(f"{home.name}/{f.relative_to(home).as_posix()}"), f.read_bytes())
    context.addPyFile(str(path))
