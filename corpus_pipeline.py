"""A corpus in, training sequences out.

Stages in order, each on all that the one before kept:

1. quality classifier: documents scored below the threshold go;
2. SimHash near-duplicates: of linked documents the one of smallest id stays;
3. benchmark decontamination: documents that hold a benchmark item, also an edited one, go;
4. best-fit packing: pieces of the remaining documents in sequences of 2048 tokens.

Every stage is a function of (spark, docs, sf_dir).  The first three return the columns of `documents`; their results
are written as Parquet in the shared folder and read again.  Nulls, empty texts, repeated rows and further columns are
treated as the operators state it; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger.llm import decontaminate, packing, simhash
from brassledger.llm import quality_cnn as cnn
from brassledger.llm.queries import table, vocabulary
from brassledger.session import ship_package, staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the given documents and keeps what scores at least the threshold."""
    ship_package(spark)
    net = cnn.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(cnn.quality(net, F.col("text")) >= cnn.THRESHOLD)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # SQL has neither a network nor a tokenizer; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
