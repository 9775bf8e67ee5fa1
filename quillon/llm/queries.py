"""The queries of this subpackage and their SQL."""

from pyspark.sql import functions as F

from quillon.llm import decontaminate, language, mixing, near_dedup, perplexity, quality, secrets, substring_dedup, token_files, url_filter


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_dups(_table(spark, sf_dir, "documents"), shingle=2)


def op2_perplexity_rules(spark, sf_dir):
    return perplexity.judge(_table(spark, sf_dir, "documents"))


def op3_token_files(spark, sf_dir):
    import public_tokenizers

    return token_files.read_token_files(token_files.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op4_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op6_secret_scan(spark, sf_dir):
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op7_compact_windows(spark, sf_dir):
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op9_source_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op10_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def queries():
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_perplexity_rules, op3_token_files, op4_benchmark_decontamination, op5_language_id, op6_secret_scan, op7_compact_windows, op8_url_filter, op9_source_mixing, op10_quality_classifier)}


def oracle_sql():
    return {"op6_secret_scan": secrets.oracle(), "op8_url_filter": url_filter.oracle(), "op9_source_mixing": mixing.oracle()}
