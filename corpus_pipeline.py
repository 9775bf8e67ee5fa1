"""Corpus pipeline: quality, near-dedup, decontamination, mixing, token files.

Each stage takes the documents that its predecessor kept, written as Parquet and read again. Rows
may lack any value, repeat or be none at all; columns beyond those of documents pass through.
"""

from quillon.llm import decontaminate, mixing, near_dedup, quality, token_files
from quillon.session import materialize, ship_package


def quality_stage(spark, docs, sf_dir):
    """Documents whose ranking score reaches the cut; empty and null texts are scored like others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.drop_rejected(docs, quality.fit(docs, labels))


def near_dedup_stage(spark, docs, sf_dir):
    """The first row of each near-duplicate group: five-word shingles, similarity 0.8 or more. Rows are judged by text, not id."""
    return near_dedup.drop_near_dups(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold no benchmark item within its edit budget."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark, docs, sf_dir):
    """Documents as often as the mix takes them, to the nearest whole number of times.

    Documents of which the mix takes less than half are left out; those without words too.
    """
    return mixing.apply_mix(docs)


def token_stage(spark, docs, sf_dir):
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    return token_files.read_token_files(token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token files", token_stage),
]

#: Trained scores, MinHash and byte-pair merges have no SQL form; a test holds run() against plain Python, row by row.
ORACLE_SQL = None


def run(spark, sf_dir):
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
