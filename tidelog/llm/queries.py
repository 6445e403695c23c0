"""One query per operator over its whole table, and the SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    bpe,
    langid,
    line_dedup,
    mil_quality,
    ngram_join,
    onebit_ann,
    packing,
    pq_dedup,
    secret_scan,
    spelling,
    toxicity,
    warc,
    whitening,
)
from tidelog.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(_table(spark, sf_dir, "documents"), n=3, threshold="0.9")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, drop=("text",)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")

    def listed(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s["via"] == "")

    def counted(kind):
        own = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in secret_scan.KINDS]
    return secret_scan.find_secrets(docs).select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_decoded"),
        "unread_layers",
    )


def _remainder(divisor: int):
    """crc32 of the id as text, modulo; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op5_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = _table(spark, sf_dir, "labels").where(_remainder(5) != 0)
    model = mil_quality.train(docs, learned)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return mil_quality.score(docs, model, drop=("text",)).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(_remainder(3) != 1))
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return langid.predict(docs.drop("lang"), model, drop=("text",)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "lines_dropped"
    )


def op9_onebit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return onebit_ann.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut_documents(_table(spark, sf_dir, "documents"), path, with_ids=False)
    return packing.pack(pieces)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = _table(spark, sf_dir, "labels").where(_remainder(3) != 1)
    model = toxicity.train(docs, learned)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return toxicity.score(docs, model, drop=("text",)).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence",
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    deviation = F.expr("try_cast(deviation AS bigint)")
    return whitening.whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", deviation)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pq_dedup": op1_pq_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_bpe": op3_bpe,
    "op4_secret_scan": op4_secret_scan,
    "op5_mil_quality": op5_mil_quality,
    "op6_langid": op6_langid,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_onebit_ann": op9_onebit_ann,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op7_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), d AS (
            SELECT page_id, body, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h,
                   max(page_id) OVER (PARTITION BY body) AS keeper
            FROM p
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
               array_to_string([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          (((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::BIGINT
                             >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1)
                   for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
        FROM d""",
    "op8_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), present AS (
            SELECT source, unnest(list_distinct([trim(x, ' ') for x in lines if trim(x, ' ') <> ''])) AS line
            FROM l WHERE source IS NOT NULL
        ), found AS (
            SELECT source, line, count(*) AS n FROM present GROUP BY ALL HAVING count(*) >= 2
        ), total AS (
            SELECT source, count(*) AS pages FROM documents GROUP BY source
        ), bad AS (
            SELECT source, list(line) AS bad FROM found JOIN total USING (source)
            WHERE n > 0.1::DOUBLE * pages GROUP BY source
        ), k AS (
            SELECT doc_id, text, lines,
                   [x for x in lines if trim(x, ' ') = ''
                      OR NOT list_contains(coalesce(bad, []::VARCHAR[]), trim(x, ' '))] AS kept
            FROM l LEFT JOIN bad USING (source)
        )
        SELECT doc_id,
               CASE WHEN len(kept) < len(lines) THEN array_to_string(kept, chr(10)) ELSE text END AS text,
               (len(lines) - len(kept))::BIGINT AS lines_dropped
        FROM k""",
}
