"""From documents to packed training sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, jaccard, packing, quality, suffix
from quarry.llm.queries import table, vocabulary
from quarry.llm.shared import Run, materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(model, F.col("text")) >= quality.DECISION)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return jaccard.keep_one(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the characters of all 200-byte strings that occur more than once; documents of which nothing but white
    space is left go."""
    out = suffix.rewritten(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, placed in sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1024)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_substrings),
    ("benchmark decontamination", benchmark_free),
    ("best-fit packing", packed),
]

#: SQL expresses neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. The tables of earlier stages are deleted as soon as they aren't needed, those of this run only."""
    docs = table(spark, sf_dir, "documents")
    with Run() as own:
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = materialize(docs, release=True)
                own.clean(spark, but=docs)
    return docs
