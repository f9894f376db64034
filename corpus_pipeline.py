"""The corpus pipeline: language, quality, near copies, packing.

Each stage reads what its predecessor kept, as written to Parquet.  An empty table passes through all stages as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmatch.llm import langid, packing, quality, simhash
from quillmatch.llm.common import Scratch, table

#: A document goes if no letter is found in it, if its language is less probable than this or if its letters are unusual in it.
LEAST_LANGUAGE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay.

    Null, empty and letterless texts go; long texts are read whole; repeated rows and rows with a null id are judged alike; other
    columns are passed on, whatever their names.  With no row to learn a language from, none is recognised.
    """
    marked = langid.predict(docs, langid.train(docs), named=("__lang", "__sure", "__rate", "__usual"))
    return marked.filter((F.col("__lang") != "und") & (F.col("__sure") >= LEAST_LANGUAGE) & F.col("__usual")).select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking puts above its cut, or on it, stay.

    Null texts are judged as empty ones; long texts are read whole; repeated rows and rows with a null id are judged alike; null
    labels teach nothing, and without both labels all documents stay; other columns are passed on, whatever their names.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, named=("__score", "__good")).filter("__good = 1").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a Jaccard similarity of 0.8 or more.

    The smallest id stays, a null one only where there is no other; of repeated rows one stays.  Texts without a word (null, empty)
    are copies of each other; long texts are read whole; other columns are passed on, whatever their names.
    """
    return simhash.keep_first(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids.

    Null and empty texts are one token, the end; long texts are cut into many pieces; repeated rows and rows with a null id are
    packed each.  Only the id and the text are read, so other columns can't clash.
    """
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_copies", drop_near_copies),
    ("packing", pack_windows),
]

#: SQL has neither the classifiers nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
