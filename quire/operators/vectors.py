"""Segments as points of a vector table: ids, hashes, and merges that can be repeated."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.latex import text_udf
from ..functions.text import col, normal_lines, strip

# The namespace of ids, the model, the version of the cut, and the size of vectors.
NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
MODEL, VERSION, DIM, PREFIX = "nomic-ai/nomic-embed-text-v1.5", "pageir_v2", 768, "search_document: "
POINTS = "id string, vector array<float>, doc_id string, page int, segment_id string, kind string, text string, source_path string, content_hash string, embedding_model string, chunk_version string, job_id string, crop_path string"


def name_uuid(name: Column, namespace: str = NAMESPACE) -> Column:
    """A version 5 UUID: the first 16 bytes of SHA-1, with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    part = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def point_id(doc: Column | str, page: Column | str, segment: Column | str, model: str = MODEL, version: str = VERSION) -> Column:
    return name_uuid(F.concat_ws("|", col(doc), col(page).cast("string"), col(segment), F.lit(model), F.lit(version)))


def normal_text(c: Column | str) -> Column:
    """NFKC, LF line ends, and no white space at line ends."""
    import unicodedata

    return normal_lines(text_udf(lambda s: unicodedata.normalize("NFKC", s.replace("\r\n", "\n").replace("\r", "\n")))(c))


def content_hash(text: Column | str, tex: Column | None = None, nfkc: bool = True) -> Column:
    body = normal_text(text) if nfkc else normal_lines(text)
    return F.sha2(F.encode(F.concat(body, F.lit("\n"), F.coalesce(tex, F.lit("")) if tex is not None else F.lit("")), "UTF-8"), 256)


def ingest_segments(page_irs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, page, segment_id, kind, text, source_path, crop_path): segments of each document's page file,
    numbered before blank ones go; a document without one is a single segment of its text.
    page_irs: (doc_id, pages); texts: (doc_id, text)."""
    pages = page_irs.select("doc_id", F.explode("pages").alias("p")).select("doc_id", F.coalesce("p.page_index", F.lit(0)).alias("page"), F.posexplode("p.segments").alias("i", "s"))
    text = strip(F.coalesce("s.text", F.lit("")))
    cut = pages.where(text != "").select("doc_id", "page", F.format_string("p%d_s%d", F.col("page").cast("long"), F.col("i").cast("long")).alias("segment_id"), F.coalesce("s.kind", F.lit("prose")).alias("kind"), text.alias("text"), F.concat("doc_id", F.lit(".pageir.json")).alias("source_path"), F.nullif("s.crop_relpath", F.lit("")).alias("crop_path"))
    bare = texts.join(page_irs.select("doc_id"), "doc_id", "left_anti")
    return cut.unionByName(bare.select("doc_id", F.lit(0).alias("page"), F.lit("p0_all").alias("segment_id"), F.lit("prose").alias("kind"), "text", F.concat("doc_id", F.lit(".txt")).alias("source_path"), F.lit(None).cast("string").alias("crop_path")))


def embed(segments: DataFrame, model: Callable[[list[str]], list[list[float]]], dim: int = DIM, text: str = "text") -> DataFrame:
    """Segments with a vector of that many components from a model; fewer or more are an error."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out = model([PREFIX + t for t in s.fillna("")])
            if len(out) != len(s) or any(len(v) != dim for v in out):
                raise ValueError(f"the model has to give {len(s)} vectors of {dim} components")
            yield pd.Series(out)

    return segments.withColumn("vector", run(normal_text(text)))


def zip_vectors(segments: DataFrame, vectors: DataFrame, position: str = "pos") -> DataFrame:
    """Segments and vectors by position; one without the other is an error."""
    both = segments.withColumn("_s", F.lit(True)).join(vectors.withColumn("_v", F.lit(True)), position, "full")
    return both.withColumn("_ok", F.when(F.col("_s").isNull() | F.col("_v").isNull(), F.raise_error(F.lit("counts of segments and vectors differ")).cast("boolean")).otherwise(True)).where("_ok").drop("_s", "_v", "_ok")


def points(embedded: DataFrame, job: Column | str, model: str = MODEL, version: str = VERSION) -> DataFrame:
    job = F.lit(job) if isinstance(job, str) else job
    return embedded.select(point_id("doc_id", "page", "segment_id", model, version).alias("id"), "vector", "doc_id", "page", "segment_id", "kind", "text", "source_path", content_hash("text").alias("content_hash"), F.lit(model).alias("embedding_model"), F.lit(version).alias("chunk_version"), job.alias("job_id"), "crop_path")


def upsert(table: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """The table with new rows in place of those of the same key; of equal new keys one stays."""
    return table.join(new.select(key).distinct(), key, "left_anti").unionByName(new.dropDuplicates([key]), allowMissingColumns=True)


def delete_documents(table: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return table.join(docs.select(key).distinct(), key, "left_anti")


def reindex(table: DataFrame, new: DataFrame) -> DataFrame:
    """All points of the new rows' documents go first."""
    return upsert(delete_documents(table, new), new)


def wrong_size(table: DataFrame, dim: int, vector: str = "vector") -> DataFrame:
    return table.where(F.col(vector).isNull() | (F.size(vector) != dim))


TILE, FAN, STRIP, TILE_BYTES = 2048, 64, 256, 2 << 20  # vectors of a tile; lists merged at a time; queries of a product; a tile's bytes, but for one vector


def tiles(rows: DataFrame, size: int = TILE) -> DataFrame:
    """(dim, ids, data): rows (id bigint, vector array<double>) in tiles of at most size vectors of one dimension, and TILE_BYTES."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, flat = zip(*held.pop(dim), strict=True)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()]), pa.array([np.concatenate(flat).tobytes()])], ["dim", "ids", "data"])

        for b in parts:
            edge, flat = b.column(1).offsets.to_numpy(), b.column(1).flatten().to_numpy()
            base = edge[0]
            for i, name in enumerate(b.column(0).to_pylist()):
                dim = int(edge[i + 1] - edge[i])
                held.setdefault(dim, []).append((name, flat[edge[i] - base : edge[i + 1] - base].copy()))  # else a vector of a rare dimension holds its whole batch
                if len(held[dim]) == max(1, min(size, TILE_BYTES // (8 * max(1, dim)))):
                    yield out(dim)
        for dim in [*held]:
            yield out(dim)

    return rows.mapInArrow(run, "dim int, ids binary, data binary")


def best_of(own: np.ndarray, asked: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores): the k best points of each query, strip by strip of the queries. ids are in order."""
    for at in range(0, len(own), STRIP):
        here = own[at : at + STRIP]
        scores = np.round(asked[at : at + STRIP] @ points.T, 12)
        scores[here[:, None] == ids[None, :]] = -np.inf
        wanted = scores > -np.inf
        if len(ids) > k:
            wanted &= scores >= np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
        row, col = np.nonzero(wanted)
        found = scores[row, col]
        order = np.lexsort((col, -found, row))
        row, col, found = row[order], col[order], found[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield here[row[keep]], ids[col[keep]], found[keep]


def products(parts: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, id, score, leaf) of pairs of tiles, one pair after the other; numbers are read where they lie in the batch."""
    unit = lambda m: m / np.sqrt((m * m).sum(1, keepdims=True))
    for b in parts:
        at = {c: b.schema.get_field_index(c) for c in b.schema.names}
        for i in range(b.num_rows):
            raw = lambda c, kind: np.frombuffer(b.column(at[c])[i].as_buffer(), kind)  # noqa: B023, E731
            dim, leaf = (b.column(at[c])[i].as_py() for c in ("dim", "leaf"))
            own, ids = raw("q_ids", np.int64), raw("ids", np.int64)
            order = np.argsort(ids, kind="stable")
            points = unit(raw("data", np.float64).reshape(-1, dim))[order]
            for query, near, score in best_of(own, unit(raw("q_data", np.float64).reshape(-1, dim)), ids[order], points, k):
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(near), pa.array(score), pa.array(np.full(len(query), leaf, np.int32))], ["query_id", "id", "score", "leaf"])


def top_k(queries: DataFrame, table: DataFrame, k: int, key: str = "id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, id, score): the k points nearest to each query by cosine, but for the query itself; ties go to
    the smaller id. Scores are in double precision, rounded to 12 places, so that equal vectors tie.

    Queries and points go in tiles; each pair of tiles is one matrix product, of which each query keeps its k best,
    and these lists are merged in two steps. Vectors that are null, zero or hold null or non-finite numbers take no part."""
    v = F.col(vector).cast("array<double>")
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = lambda df: df.where(F.col(key).isNotNull()).where(good).select(F.col(key).cast("bigint").alias("id"), v.alias("vector"))
    leaves = max(1, -(-table.count() // TILE))
    asked = tiles(rows(queries)).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(leaves - 1))).alias("leaf"))
    points = tiles(rows(table)).withColumn("leaf", F.pmod(F.xxhash64("ids"), F.lit(leaves)).cast("int"))

    lists = asked.join(points, ["dim", "leaf"]).mapInArrow(lambda parts: products(parts, k), "query_id bigint, id bigint, score double, leaf int")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))), 1, k)
    lists = lists.groupBy("query_id", F.floor(F.col("leaf") / FAN).alias("leaf")).agg(top.alias("x")).select("query_id", F.explode("x").alias("x")).select("query_id", "x.id", (-F.col("x.down")).alias("score"))
    last = lists.groupBy("query_id").agg(top.alias("x")).select("query_id", F.posexplode("x").alias("at", "x"))
    return last.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(key), (-F.col("x.down")).alias("score"))


def ensure_collection(spark: SparkSession, name: str, dim: int = DIM, metric: str = "cosine") -> bool:
    """A table of points with its vector size and metric among its properties, made only if there is none of that name;
    tells whether it was made."""
    if spark.catalog.tableExists(name):
        return False
    properties = f"'dim'='{int(dim)}', 'metric'='{metric}'"
    spark.sql(f"CREATE TABLE {name} ({POINTS}) USING parquet TBLPROPERTIES ({properties})")
    return True


def collection_info(spark: SparkSession, name: str) -> dict[str, str]:
    """The vector size and the metric of a table of points."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {k: found[k] for k in ("dim", "metric")}
