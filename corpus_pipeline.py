"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept; what a stage returns is written as Parquet and reread. All but the last return
the columns of documents. Stages define each odd case as their operators do: null or
empty texts fall to the quality and language stages, rows with a null doc_id pass,
an empty table stays empty. Rows that share a doc_id are judged each by its own text,
ties go as the operators say, very long texts are read whole, and columns with
clashing names pass through every stage but the last unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm.language import keep_identified
from loomtrace.llm.mixing import mixed_documents
from loomtrace.llm.near_duplicates import drop_near_duplicates
from loomtrace.llm.quality import keep_quality
from loomtrace.llm.queries import MIX_WEIGHTS, WEIGHTS_SCHEMA, domain_of
from loomtrace.llm.scratch import Scratch
from loomtrace.llm.sentencepiece import MODEL, encode, load_model
from loomtrace.sources.tables import table

#: Part of the tokens that the mix keeps, and its seed.
MIX_SHARE, MIX_SEED = 0.8, 17


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier scores below one half."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter and those far from the labelled text of every language."""
    return keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group linked by five-word shingles with a Jaccard index of 0.8 or more."""
    return drop_near_duplicates(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents of a mix of one epoch with four fifths of the tokens, by the weights of domains and languages."""
    weights = spark.createDataFrame(MIX_WEIGHTS, WEIGHTS_SCHEMA)
    return mixed_documents(docs, domain_of(docs["source"]), weights, share=MIX_SHARE, seed=MIX_SEED)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, pieces): the piece ids of every text, from which decoding gives it back."""
    encoded = encode(docs.select("doc_id", "lang", "source", "text"), load_model(MODEL))
    return encoded.select("doc_id", "lang", "source", F.greatest(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "pieces")


STAGES = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("near-duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: No SQL: the classifier, the automata and the Viterbi search are beyond it. Stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each earlier one is written to the shared folder and reread."""
    scratch = Scratch(spark, "pipeline")
    docs, previous = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = scratch.keep(docs, name.replace(" ", "-"))
            if previous is not None:
                scratch.drop(previous)
            previous = docs
    return docs
