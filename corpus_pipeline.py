"""The corpus pipeline: toxicity, exact dedup, near duplicates, mixing, packing, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanloom.llm import exact_dedup, mixing, near_duplicates, packing, toxicity
from cleanloom.llm.common import staged
from cleanloom.llm.queries import LIMIT, table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled rows of the table documents. Null and empty texts have a
    score like any other (all filters at their bias); texts are read whole; repeated rows are judged alike; an empty table stays empty."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; null ids are smallest, null texts are empty, of rows with the same id and text
    the last in the table stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id stays; null ids sort last, of rows with the same id the first in the
    table stays. Texts without words (null, empty) are near nothing and all stay."""
    return near_duplicates.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stream of whole documents, each as often as the mix takes it; documents of size 0 (null, empty, only ASCII white space) are dropped.
    Null is a source of its own, the last; repeated rows are documents of their own."""
    return mixing.mix(docs, weights=(5, 2, 1))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document of the stream, a repeated one each time, in pieces with their places in sequences. Null text counts as empty: one piece,
    which holds the end id. No other columns are returned."""
    packed = packing.pack_documents(docs, vocabulary(), LIMIT)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("weighted_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: the classifier, the tokenizer and the packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's result is written; what the stage staged on its way goes then."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = staged(lambda function=function, docs=docs: function(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return docs
