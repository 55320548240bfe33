"""The document pipeline: five stages, each a function of (spark, docs, sf_dir).

1. quality rules: documents that fail, or whose host fails, go;
2. MinHash near-dedup: one document of each group stays;
3. benchmark decontamination: documents with a benchmark window go;
4. secret scans: found secrets are masked in the text;
5. byte-level BPE: the token ids of what is left.

All stages but the last return the columns of ``documents``. ``run`` writes
each stage's result to the shared folder and hands the stored table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kredex.llm import byte_bpe, decontaminate, host_rules, near_dups, secrets
from kredex.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_rules.quality_filter(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The near-dedup and BPE stages have no SQL form; tests/llm holds the
#: brute-force version.
ORACLE_SQL = None
