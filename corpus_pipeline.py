"""The training-data pipeline: rejects, joins copies, redacts, mixes and packs documents.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns the rows that the next stage works on. All but the last keep the columns
of documents, whatever their names. run() writes every stage to the shared folder
and rereads it. An empty table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import ngram_join
from panelcast.llm.common import stage, table
from panelcast.llm.mixing import Mix, remixed
from panelcast.llm.packing import pack_documents
from panelcast.llm.quality import kept_documents
from panelcast.llm.secrets import redact

#: Budget None gives every source one whole pass, so that the mix drops no document.
MIX = Mix(budget=None, max_repeats=2.0)


def reject(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null and empty texts don't, repeated rows fare alike."""
    return kept_documents(docs)


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id, rows without id last; equal rows are one.

    Rows that share an id, or have none, are told apart by their texts. Empty texts stay.
    """
    return ngram_join.one_of_copies(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced in the text and n_chars to match; null texts stay null."""
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a null source is a source."""
    return remixed(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by training sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", reject),
    ("n-gram Jaccard join", one_of_copies),
    ("secret scans", redacted),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: Hashes, a tokenizer and an iterative join are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
