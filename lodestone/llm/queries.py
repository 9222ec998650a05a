"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import divergence, licenses
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .automaton_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import linked

    return linked(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(table(spark, sf_dir, "documents"), limit_bytes=SHARD_BYTES)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings")).drop("deviation_exact")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents"))


#: Bytes of text that a shard holds at most: small, so that the directory splits at every size of the tables.
SHARD_BYTES = 32 << 10

QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_suffix_dedup, op3_decontaminate, op4_toxicity, op5_automaton_dedup, op6_quality, op7_bpe, op8_jaccard_join, op9_sharding, op10_media, op11_whitening, op12_divergence, op13_license_scan)}

ORACLE_SQL = {
    # the leaf of a row is the least depth at which its bucket fits or it is alone; above the limit it is a page of its own
    "op9_sharding": f"""
        WITH r AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
        g AS (SELECT doc_id, n_bytes, h, d FROM r CROSS JOIN range(0, 61) t(d)),
        s AS (SELECT doc_id, n_bytes, d, h >> (60 - d) AS prefix, sum(n_bytes) OVER (PARTITION BY d, h >> (60 - d))::BIGINT AS bytes, count(*) OVER (PARTITION BY d, h >> (60 - d)) AS n FROM g)
        SELECT doc_id, n_bytes, d::INTEGER AS depth, prefix::BIGINT AS prefix, CASE WHEN bytes > {SHARD_BYTES} THEN -1 ELSE 0 END::BIGINT AS page, bytes AS shard_bytes, bytes > {SHARD_BYTES} AS over_limit
        FROM s WHERE bytes <= {SHARD_BYTES} OR n = 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
    """,
    "op12_divergence": divergence.oracle(),
    "op13_license_scan": licenses.oracle(),
}
