"""The corpus pipeline: quality rules, n-gram Jaccard join, substring dedup, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and reread as the next one's ``docs``. All but the last keep the columns of
``documents``. ``run`` applies them to ``documents``, with the tables between in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import common, ngram_join, packing, quality, repeats
from tidemill.llm.tokenizers import PATTERN, TOKENIZER_FILE

#: Near copies: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80
#: Repeated passages: windows of this many words.
WINDOW = 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep; the model is fitted on the labelled ones among ``docs``."""
    labels = common.table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.filtered(docs, quality.fit(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return ngram_join.one_of_each(docs, SHINGLE, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that occur twice; ``n_chars`` follows the text."""
    return repeats.without_repeats(docs, WINDOW)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, with their ids."""
    return packing.pack(docs, TOKENIZER_FILE, PATTERN, with_ids=True)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_copies),
          ("substring dedup", repeated_passages), ("packing", packed)]

#: SQL expresses neither the fitted chain nor the online placement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.staged(docs, f"stage-{k}")
    return docs
