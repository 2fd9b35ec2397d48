"""What the operators of this folder share: inputs, the shared folder, written steps."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors see")
    own = f"file://{tempfile.gettempdir()}/quire-{os.getpid()}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: lineage ends here, and a lost
    executor costs no more than the tasks it ran."""
    ship(df.sparkSession)
    path = fresh_folder(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what ``written`` wrote, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_quire_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
