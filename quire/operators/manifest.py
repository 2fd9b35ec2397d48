"""Job manifests: what their fields, paths and files have to be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of version 1.
FIELDS = ["done_schema", "job_id", "doc_id", "created_at", "source_pdf", "artifacts", "ocr_pipeline_version"]
NAME = "[a-zA-Z0-9][a-zA-Z0-9._-]{1,127}"
JOB_ID, SHA = rf"\A{NAME}\z", r"\A[0-9a-f]{64}\z"


def unsafe(path: Column) -> Column:
    """Empty, absolute, or with a step up."""
    return (path == "") | path.startswith("/") | path.startswith("\\") | path.rlike(r"\A[A-Za-z]:") | F.array_contains(F.split(path, r"[/\\]"), "..")


def errors(raw: Column | str = "manifest") -> Column:
    """What is wrong with a manifest given as JSON text, in order."""
    text = F.col(raw) if isinstance(raw, str) else raw
    m = F.from_json(text, "done_schema string, job_id string, doc_id string, created_at string, source_pdf string, ocr_pipeline_version string, artifacts array<struct<path:string,sha256:string>>")
    schema = F.to_json(F.try_variant_get(F.try_parse_json(text), "$.done_schema", "variant"))
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, FIELDS))))
    paths = F.coalesce(F.transform(m["artifacts"], lambda a: a["path"]), F.array().cast("array<string>"))
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    no = lambda c: F.coalesce(c, F.lit(True))
    parts = F.from_json(F.get_json_object(text, "$.artifacts"), "array<map<string,string>>")
    checks = [
        (F.size(extra) > 0, F.concat(F.lit("unknown fields: "), F.array_join(extra, ", "))),
        # The number 1; a text that says so isn't.
        (no(~schema.isin("1", "1.0", "true")), F.lit("done_schema must be 1")),
        (no(~m["job_id"].rlike(JOB_ID)), F.lit("bad job_id")),
        (no(~F.length(m["doc_id"]).between(1, 128)), F.lit("bad doc_id")),
        (blank(m["created_at"]), F.lit("bad created_at")),
        (F.coalesce(m["source_pdf"].rlike(r"[/\\]"), F.lit(False)), F.lit("source_pdf must be a basename")),
        (blank(m["ocr_pipeline_version"]), F.lit("bad ocr_pipeline_version")),
        (F.size(paths) == 0, F.lit("artifacts must be a non-empty list")),
        (F.coalesce(F.exists(parts, lambda a: F.array_sort(F.map_keys(a)) != F.array(F.lit("path"), F.lit("sha256"))), F.lit(False)), F.lit("artifact must have path and sha256")),
        (F.exists(paths, lambda p: F.coalesce(unsafe(p), F.lit(True))), F.lit("unsafe artifact path")),
        (F.size(F.array_distinct(paths)) < F.size(paths), F.lit("duplicate artifact path")),
        (F.coalesce(F.exists(m["artifacts"], lambda a: F.coalesce(~a["sha256"].rlike(SHA), F.lit(True))), F.lit(False)), F.lit("bad sha256")),
        (~F.coalesce(F.array_contains(paths, F.concat(m["doc_id"], F.lit(".txt"))), F.lit(False)), F.lit("missing text artifact")),
    ]
    return F.array_compact(F.array(*[F.when(bad, said) for bad, said in checks]))


def artifacts(manifests: DataFrame, raw: str = "manifest") -> DataFrame:
    """(job_id, doc_id, path, sha256)."""
    m = F.from_json(raw, "job_id string, doc_id string, artifacts array<struct<path:string,sha256:string>>")
    return manifests.select(m.alias("m")).select("m.job_id", "m.doc_id", F.explode("m.artifacts").alias("a")).select("job_id", "doc_id", "a.path", "a.sha256")


def against_disk(listed: DataFrame, disk: DataFrame) -> DataFrame:
    """(job_id, path, problem): listed files that are missing or other ones. disk: (job_id, path, sha256)."""
    there = disk.withColumnRenamed("sha256", "found")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("sha256"), "mismatch")
    return listed.join(there, ["job_id", "path"], "left").select("job_id", "path", problem.alias("problem")).where("problem is not null")


def unlisted(listed: DataFrame, disk: DataFrame) -> DataFrame:
    """(job_id, path): the document's files and figures on disk that its manifest doesn't list."""
    docs = listed.select("job_id", "doc_id").distinct()
    counts = F.col("path").rlike(r"\Afigures/[^/]*\.png\z") | (F.col("path") == F.concat("doc_id", F.lit(".pageir.json"))) | (F.col("path") == F.concat("doc_id", F.lit(".tex")))
    return disk.join(docs, "job_id").where(counts).join(listed, ["job_id", "path"], "left_anti").select("job_id", "path")


def valid(manifests: DataFrame, disk: DataFrame, raw: str = "manifest") -> DataFrame:
    """Manifests without errors whose files are all there, the same, and listed."""
    good = manifests.where(F.size(errors(raw)) == 0).withColumn("job_id", F.get_json_object(raw, "$.job_id"))
    listed = artifacts(good, raw)
    bad = against_disk(listed, disk).select("job_id").union(unlisted(listed, disk).select("job_id")).distinct()
    return good.join(bad, "job_id", "left_anti")
