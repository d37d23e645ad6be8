"""A corpus from raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame,
which is stored and read again as the next stage's documents. All but the last return the
columns of their input.

1. quality: documents that the classifier rejects go; those without text words are scored
   like the others.
2. exact_dedup: of equal texts the row with the largest id stays. Null counts as empty.
3. near_dedup: of near duplicates (five-word shingles, similarity 0.8) the smallest id stays.
4. personal_data: spans are replaced by their kind; `n_chars`, if it is a number, follows the
   text (null where its type can't hold the length); of another type it stays as it is.
5. packing: whole documents as pieces with their packed ids, placed in sequences of 2048.

Null or empty texts pass through every stage as empty texts; an empty table gives an empty
result; further columns are carried to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from predial.llm import exact_dedup, jaccard_join, packing, pii, quality
from predial.llm.support import fresh, prepare, table
from predial.session import scratch_folder

REJECT_BELOW = 0.5
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    scored = quality.with_score(docs, weights, score=score)
    return scored.filter(F.col(score) >= REJECT_BELOW).drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.drop_near_copies(docs)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    clean = pii.redact(docs, pii.train(docs))
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    if isinstance(kind, NumericType):
        clean = clean.withColumn("n_chars", F.length("text").try_cast(kind))
    return clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("personal_data", personal_stage),
    ("packing", packing_stage),
]

#: Classifier, similarity join and tokens can't be said in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(prepare(spark), sf_dir, "documents")
    folder = scratch_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
