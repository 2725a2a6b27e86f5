"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import jaccard, language, packing, quality, substrings
from farelake.llm.common import remainder
from farelake.session import materialize

#: Words of a repeated passage from which on it is removed: shorter ones are stock phrases as often as copies.
PASSAGE_WORDS = 50


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the models are learned from the documents that name theirs."""
    models = language.learn(docs, remainder(F.col("doc_id"), 3) != 1)
    return language.identify(docs, models).where(~F.col("rejected")).select("_row.*")


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives at least 0.3; it is fitted on the labelled ones of the table ``labels``.

    Where none of them is labelled nothing is known of their quality, and all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.learn(docs.select("doc_id", "text"), labels, lambda doc_id: remainder(doc_id, 5) != 0)
    if not network.learned:
        return docs
    return quality.score(docs, network).where(F.col("score") >= 0.3).select("_row.*")


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (five-word shingles, similarity 0.8), the document with the smallest id.

    Rows are told apart by a key of their own, so different texts that share an id both stay, and of equal ones without
    an id one does. A null id counts as larger than any other. A text without words is like no other, and stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = materialize(docs.select(row, F.monotonically_increasing_id().alias("_key")), "rows")
    found = jaccard.similar_documents(rows.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text")))
    order = F.struct(F.col("_row.doc_id").isNull().alias("none"), F.col("_row.doc_id").alias("doc_id"), "_key")
    named = rows.select("_key", order.alias("order")).join(found.select(F.col("doc_id").alias("_key"), "component_id"), "_key")
    kept = named.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col("order._key").alias("_key"))
    return rows.join(kept.hint("merge"), "_key", "left_semi").select("_row.*")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that a document with a smaller id has."""
    found = substrings.dedup_passages(docs, window=PASSAGE_WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_row.text"))
    fresh = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("_row.n_chars"))}
    columns = []
    for field in docs.schema:
        value = fresh.get(field.name, F.col(f"_row.`{field.name}`"))
        columns.append(value.cast(field.dataType).alias(field.name))
    return found.select(*columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4,096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", keep_known_languages),
    ("quality", keep_good_quality),
    ("near duplicates", keep_one_of_similar),
    ("passages", remove_repeated_passages),
    ("packing", pack_sequences),
]

#: No stage can be said in SQL: they learn models, or need the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
