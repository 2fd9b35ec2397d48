"""The queries of this folder's operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, gridjoin, licenses, minhash, packing, quality, topk, toxicity, warc
from .common import table, tokenizer_path
from .tiles import usable


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return bpe.decode(ids, tokenizer_path()).select("doc_id", bpe.token_count(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


#: Where documents lie: a tree of sources, languages, hundreds and tens; the first of each ten and hundred is named like a licence file.
PATH = "concat_ws('/', source, lang, 'h' || (doc_id - doc_id % 100), CASE WHEN doc_id % 100 <> 0 THEN 't' || (doc_id - doc_id % 10) END, CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' || CASE WHEN doc_id % 20 = 0 THEN '.txt' ELSE '' END ELSE doc_id || '.txt' END)"


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", F.expr(PATH).alias("path"), "text"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), topk.whole(F.col("embedding")).alias("vector"))
    return topk.search(rows.where("id % 100 = 0"), rows)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.resample(documents, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "gumbel_key", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", sample), (-1, 1, "assistant", sample)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    told = chat.format_records(chat.records_of(rows))

    def digest(pieces: Column) -> Column:
        loss = chat.unescape_each(pieces)
        return chat.let(chat.joined(pieces), lambda formatted: chat.let(chat.parse(formatted), lambda turns: chat.let(loss, lambda text: F.struct(
            F.size(turns).cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length(text).cast("bigint").alias("loss_chars"),
            F.sha2(text, 256).alias("loss_sha256"),
            F.length(formatted).cast("bigint").alias("formatted_chars"),
        ))))

    return told.select("conv_id", F.inline(F.array(chat.let(F.col("segments"), digest))))


def op8_gridjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.join(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.withColumn("kept", F.col("doc_id") == F.col("class_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_licenses": op2_licenses,
    "op3_topk": op3_topk,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_chat": op7_chat,
    "op8_gridjoin": op8_gridjoin,
    "op9_packing": op9_packing,
    "op10_minhash": op10_minhash,
}

#: Whether all components of a vector are finite numbers, none of them null.
FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES: dict[str, str] = {
    "op3_topk": f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings WHERE {FINITE}),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.w, v.w)::BIGINT AS score
              FROM v AS q, v WHERE q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id AND len(q.w) = len(v.w)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op2_licenses": licenses.oracle(PATH),
    "op4_warc": """
        WITH h AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM h)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (((((strpos('0123456789abcdef', substr(h, (5 * g) // 4 + 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(h, (5 * g) // 4 + 2, 1)) - 1)
                >> (3 - (5 * g) % 4)) & 31) + 1)::INT, 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM f""",
    "op7_chat": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>)', '\1\\\2\3', 'g') AS text2,
              regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>)', '\1\\\2\3', 'g') AS role2 FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('<|im_start|>') + length(role2) + 1 + length(text2) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op8_gridjoin": f"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS w FROM embeddings
                   WHERE {FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM v AS a, v AS b
                 WHERE a.vec_id <> b.vec_id AND len(a.w) = len(b.w) AND list_cosine_similarity(a.w, b.w) >= 0.9),
        reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
        least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
        many AS (SELECT u, count(*) AS n FROM link GROUP BY u)
        SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN least ON e.vec_id = least.u LEFT JOIN many ON e.vec_id = many.u""",
}
