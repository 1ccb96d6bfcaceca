"""A training corpus from ``documents``, in five stages.

1. toxicity: documents scored as toxic go;
2. near_dedup: of each class of near-duplicates one document stays;
3. decontamination: documents that leak a benchmark item go;
4. pii: personal data become pseudonyms;
5. packing: the rest is tokenised and packed into sequences.

Every stage works on all that the one before it kept, which is written as
Parquet to the shared scratch folder and read again. All but the last return
the columns of documents. Null and empty texts are not toxic, not duplicates
and not contaminated; the last stage packs them as empty documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revgraph.llm import decontam, neardup, packing, pii, toxicity
from revgraph.llm.common import crc32_of, lean_batches, stored, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), crc32_of() % 3 != 1))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    return neardup.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    return pii.pseudonymise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("pii", pseudonymised),
    ("packing", packed),
]

#: No SQL states what classifiers, sampling and a tokenizer do; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
