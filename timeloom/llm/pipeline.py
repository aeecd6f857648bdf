"""From raw documents to packed training sequences.

Stages: a quality classifier, language identification, near-duplicate removal,
mixing the sources to target weights, packing.  Every stage works on all that
the one before kept, which is written as Parquet and read again; all but the
last return the columns of documents.

Corner cases are those of the operators: null texts are judged by what remains
and, as no language is theirs, leave with the second stage, as do empty ones;
null ids, sources and languages are values; very long texts are read whole;
rows that agree in id and text are one document from the third stage on; a
score equal to a bound is kept; columns of other names, clashing ones too, are
carried to the last stage; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import common, op3_mixing, op4_packing, op6_language, op9_jaccard_join, op10_quality

#: A document is rejected below these scores.
QUALITY, LANGUAGE = 0.5, 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the co-trained classifiers accept."""
    model = op10_quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, names, back = common.set_aside(docs, *(c for c in op10_quality.RECORD if c in docs.columns))
    return op10_quality.score(rows, model, *names).where(F.col("score") >= QUALITY).select(*back)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a known language that labels most of their letters."""
    rows, names, back = common.set_aside(docs)
    scored = op6_language.identify(rows, op6_language.learn(docs), *names)
    return scored.where((F.col("lang_pred") != op6_language.UND) & (F.col("score") >= LANGUAGE)).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every group of near copies."""
    return op9_jaccard_join.first_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words meet their targets."""
    return op3_mixing.resample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the documents into token windows."""
    import public_tokenizers

    return op4_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL says what trained classifiers and packing do; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
