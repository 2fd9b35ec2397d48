"""A corpus pipeline of four operators: documents of low quality go, toxic ones go, one document of each group
of near duplicates stays, and what is left is packed into sequences.

Each stage works on all rows that the one before it kept, written as Parquet and read back. Stages but the
last return the columns of their input. Rows with a null id pass the near-duplicate stage; of rows that
repeat an id and text, it keeps one. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import minhash, packing, quality, toxicity
from quire.llm.common import table, tokenizer_path, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.resample(docs, table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = minhash.groups(docs).where("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").withColumn("_same", F.xxhash64("text")).dropDuplicates(["doc_id", "_same"])
    return kept.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, tokenizer_path(), keep_ids=False))


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("minhash", minhash_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: No stage but the joins within them can be said in SQL; tests hold them against plain versions.
ORACLE_SQL = None
