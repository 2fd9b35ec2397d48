"""Published jobs as a stream: manifests that arrive are checked, and their segments merged into a table.

Ids come from names, so a batch that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import manifest


def arriving(spark: SparkSession, jobs: str) -> DataFrame:
    """(manifest, errors) of each manifest that appears under a folder of jobs."""
    raw = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "DONE.json").load(jobs)
    return raw.select(F.col("value").alias("manifest"), manifest.errors(F.col("value")).alias("errors"))


def ingest(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Valid manifests to a function that merges a batch."""
    good = stream.where(F.size("errors") == 0).select("manifest")
    writer = good.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
