"""Raw documents to training tokens in five stages, each over all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written and read again as the next one's docs. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm import bpe, jaccard, pii, ppm, raking
from strataflow.session import stage

# The mix stays close to the corpus: shares go with the tokens to this power.
TEMPER = 0.9
# Probability from which a predicted language overrules a label.
CERTAIN = 0.999


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty or letterless text) go; a missing label is filled in.

    A label gives way to another language that is CERTAIN, so a mislabelled text goes on under its own. Long texts are
    read whole; rows that repeat stay, each; other columns are carried, whatever their names.
    """
    told = ppm.predict(docs, ppm.fit(docs), names=("__lang", "__score")).filter(F.col("__lang") != ppm.UNDETERMINED)
    sure = F.col("lang").isNull() | (F.col("__score") >= CERTAIN)
    kind = docs.schema["lang"].dataType
    return told.withColumn("lang", F.when(sure, F.col("__lang").cast(kind)).otherwise(F.col("lang"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays.

    Rows without an id stay as they are; of rows that repeat an id one stays, by text.
    """
    groups = jaccard.similar_sets(docs)
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(*[F.col(c).asc_nulls_last() for c in docs.columns if c != "doc_id"])
    ranked = docs.join(kept, "doc_id", "left_semi").withColumn("__rank", F.row_number().over(first))
    return ranked.filter("__rank = 1").select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data gives way to its kind in brackets; n_chars follows the new text.

    Null and empty texts stay as they are; long ones are searched whole; repeated rows come out alike.
    """
    told = pii.find(docs, column="__spans").withColumn("text", pii.redact(F.col("text"), F.col("__spans")))
    length = F.when(F.size("__spans") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return told.withColumn("n_chars", length).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the tempered shares of sources, languages and formats.

    Null is a source or language of its own. A text without a word has no weight and is not drawn; repeated rows that
    have an id are drawn or left together; an empty table gives an empty one.
    """
    named = docs.withColumn("__topic", raking.format_of(F.col("text")))
    marginals = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col("__topic")}
    mixed = raking.mix(named, marginals, temper=TEMPER, drop=["__topic"], names=("__n", "__weight", "__probability", "__copies"))
    return mixed.filter("__copies > 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text. A null or empty text has none; repeated rows
    come out alike."""
    coded = bpe.tokenize(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        outputs=("ids", "n_tokens", "decoded_sha256"),
    )
    same = F.col("decoded_sha256") == F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return coded.select("doc_id", "source", "lang", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Language, personal data and tokens have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
