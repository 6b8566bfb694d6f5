"""The corpus pipeline: language, quality, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which is stored and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscope.llm import language, packing, quality, simhash, suffixes
from tallyscope.llm.queries import WORD_VOCABULARY, vocabulary
from tallyscope.sources.durable import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with a calibrated score of at least one half."""
    told = language.identify(docs)
    return told.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the rules, without the lines found to be boilerplate of their host."""
    kept = quality.judge(docs, with_text=True, carry=("lang", "source")).where("kept")
    return kept.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.char_length("clean_text").cast("long").alias("n_chars"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep exactly one row of each component: the least id (nulls last), then the least hash of text and row."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated passages out; documents with nothing left go."""
    cut = suffixes.without_repeats(docs)
    cut = cut.withColumn("text", F.col("cut.kept_text")).withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.where("n_chars > 0").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two lengths."""
    return packing.pack(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("language", language_stage), ("quality", quality_stage), ("near_copies", near_copy_stage),
    ("passages", passage_stage), ("packing", packing_stage),
]

#: Language models, fingerprints and token ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
