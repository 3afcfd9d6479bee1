"""A training corpus from ``documents`` in five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir); ``run`` writes its rows as Parquet in the shared folder and
reads them again as the next stage's documents.

A document is a row. Null texts are empty texts: they are scored by the classifier like others, are copies of each other for the exact
dedup, link with nothing, have no tokens in the mix and come with the prefix they fall in, and encode to no pieces. Rows
without doc_id are documents too; they link with nothing, and share one place in the mix's order. A row that is repeated whole stays once, and rows that share a
doc_id but not the text are told apart. Of copies the longest text stays, then the smallest doc_id; of a component of near copies its smallest
doc_id; ties in the mix go together. Texts of any length pass whole. Extra columns come along, whatever their names, up to the last stage. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.llm import exact_dedup, jaccard_join, mixing, piece_codec, rule_classifier
from signalmill.llm.queries import source_domain
from signalmill.llm.storage import scratch, table

#: The corpus takes no document twice: shortages are made up by siblings only.
MIX = mixing.Mix(share=0.85, max_epochs=1, seed=17, domains={"crawl": 35, "library": 35, "forum": 30}, languages={"en": 40, "de": 20, "fr": 20, "es": 20})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, doesn't reject."""
    model = rule_classifier.train(docs, table(spark, sf_dir, "labels"), ~rule_classifier.held_out(F.col("doc_id")))
    return rule_classifier.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents that differ in white space only."""
    return exact_dedup.keep_first_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents that links of Jaccard similarity 0.8 over 5-word shingles join."""
    return jaccard_join.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of domains, languages and sources with the target weights."""
    return mixing.taken_rows(docs, source_domain(), MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives its text back."""
    return piece_codec.encode_documents(docs)


STAGES = [
    ("7 quality classifier", quality),
    ("10 exact dedup", exact),
    ("2 n-gram Jaccard join", near),
    ("5 mixing sources", mix),
    ("4 SentencePiece encoding", encode),
]

#: Rule ensembles and byte-pair merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. What a stage writes for itself is deleted when its rows are written; the last one's rows are given as they come."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
