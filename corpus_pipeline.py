"""The corpus pipeline: toxic documents go, repeated lines go, one of each group of near duplicates stays, documents that
hold a benchmark passage go, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents; the
last returns the pieces of the packed sequences. Packing is SQL-inexpressible (a tokenizer), as is the toxicity network,
so that there is no ORACLE_SQL; tests hold the stages against brute force.

All stages read whole texts and every row. Rows with a null or empty text go through all stages (unless the network finds
an empty text toxic) and come out as documents of no token but the end mark. Rows with a null doc_id, equal rows and
several texts with one doc_id are defined below. Further columns, whatever their names, come through unchanged up to the
last stage. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacantia.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from vacantia.llm.tables import discard, table, through_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, unchanged. Equal texts have equal scores, so copies go or stay together.

    Labels are learnt from rows that are not held out; without labels of both kinds nothing is dropped. A null or empty
    text has the score of an empty window. The score is no column of the result.
    """
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; those that lose all of their words go.

    Earlier is by (doc_id, hash of the text, line), null doc_ids first; equal rows are one document and lose the same lines.
    Blank lines stay, and so does a document without words that lost nothing. n_chars follows the text where lines went.
    """
    return line_dedup.without_repeats(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of documents that links connect; all others unchanged.

    What goes is told by doc_id and text: of several texts with one doc_id each is judged on its own, equal rows stay
    together. Texts without words and rows with a null doc_id link with nothing and stay.
    """
    return ngram_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, unchanged. Null items and an empty benchmark match nothing."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences: every token of every document in exactly one. Null texts are empty ones."""
    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read by the next."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir), name)
        if last is not None:  # nothing reads it any more
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
