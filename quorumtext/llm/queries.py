"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from .common import documents


def op1_token_counts(spark, sf_dir):
    from .token_count import token_counts
    from pyspark.sql import functions as F

    return token_counts(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > 2048)


def op2_line_dedup(spark, sf_dir):
    from .line_dedup import dedup_lines

    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_deleted")


def op3_order_minhash(spark, sf_dir):
    from .order_minhash import near_groups

    return near_groups(documents(spark, sf_dir))


def op4_exact_dedup(spark, sf_dir):
    from .exact_dedup import exact_groups

    return exact_groups(documents(spark, sf_dir)).drop("heavy")


def op5_quality_crf(spark, sf_dir):
    from .quality_crf import score_held_out

    return score_held_out(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_mixing(spark, sf_dir):
    from .mixing import mix

    return mix(documents(spark, sf_dir))


def op7_best_fit_packing(spark, sf_dir):
    from .packing import pack_documents

    return pack_documents(documents(spark, sf_dir))


def op8_minhash_fingerprints(spark, sf_dir):
    from .fingerprint import fingerprints

    return fingerprints(documents(spark, sf_dir))


def similar_documents_by_bands(spark, sf_dir):
    """Operator 8's fingerprints at work: bands joined, Jaccard verified."""
    from .fingerprint import similar_documents

    return similar_documents(documents(spark, sf_dir))


def op9_sharding(spark, sf_dir):
    from .sharding import shard_documents

    return shard_documents(documents(spark, sf_dir))


def op10_language_ppm(spark, sf_dir):
    from .language_id import identify_held_out

    return identify_held_out(documents(spark, sf_dir))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_line_dedup, op3_order_minhash, op4_exact_dedup, op5_quality_crf, op6_mixing, op7_best_fit_packing, op8_minhash_fingerprints, op9_sharding, op10_language_ppm, pipeline, similar_documents_by_bands)}


def oracle_sql() -> dict[str, str]:
    from .mixing import mixing_sql

    return {"op4_exact_dedup": OP4, "op6_mixing": mixing_sql()}


OP4 = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
