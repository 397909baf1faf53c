"""The corpus pipeline: documents through quality rules, near-dedup, decontamination, secret scan and tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared
folder and rereads it as the next stage's docs. All but the last return the columns of ``documents``.

Rows are dropped by the first three stages: those that fail the quality rules, near-duplicates of a
smaller doc_id that is in the corpus, and documents with a passage of the benchmark. The last two
decide by row, so null and repeated doc_ids drop no other rows; equal rows are near-duplicates. The fourth
replaces secrets in the text and keeps every row. The last returns ids and the decoded text's digest.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import op2_decontaminate, op3_near_dup, op4_pieces, op7_quality, op10_secrets
from gazette.llm.shared import Disposable, bound_batches, materialize, table

#: Parts whose ids a worker keeps in the last stage. By then an executor's heap may be as large as it gets, so half of what op4 alone keeps.
KEPT_PARTS = op4_pieces.KEPT_PARTS // 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return op3_near_dup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an exact match of a benchmark window go."""
    bound_batches(spark)
    rows, row = op3_near_dup.numbered(docs)
    with Disposable(spark) as d:
        found = op2_decontaminate.find_contamination(op3_near_dup.by_row(rows, row), table(spark, sf_dir, "benchmark"), slop=0)
        dropped = d.keep(found.where(F.size("hits") > 0).select("doc_id"), "contaminated")
    return op3_near_dup.without_rows(rows, row, dropped)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return op10_secrets.redact(docs, op10_secrets.default_forest(spark), op10_secrets.default_dictionary())


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the SHA-256 of the ids and of the decoded text."""
    import public_tokenizers

    bound_batches(spark)
    encoded = op4_pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), kept=KEPT_PARTS)
    ids = F.split("ids", " ").cast("array<int>")
    return encoded.select("doc_id", "n_tokens", ids.alias("ids"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("pieces", pieces)]

#: Near-duplicates, the forest and the tokenizer aren't SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
