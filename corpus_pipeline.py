"""The corpus pipeline: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. Null and empty texts, repeated rows and empty tables are
handled as the operators define; columns beside the five of ``documents`` are not carried on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caregauge.llm import langid, packing, quality, simhash
from caregauge.llm.common import table
from caregauge.sources.scratch import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected below this quality score.
QUALITY = 0.7
#: A text whose cost under its best language is above this share of the cost of letters drawn at
#: random from the sample's symbols is in none of the learned languages.
FOREIGN = 0.9


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the line model finds good."""
    model = quality.learned(docs, table(spark, sf_dir, "labels"), 4, 2)
    kept = quality.scored(docs, model, COLUMNS)
    return kept.where(F.col("score") >= QUALITY).select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with letters, in one of the learned languages."""
    samples = langid.learned(docs, 5, 0)
    found = langid.predicted(docs, samples, COLUMNS)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_char") <= FOREIGN * langid.random_cost(samples))
    return found.where(known).select(*COLUMNS)


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near-duplicates, that of the smallest id.

    Rows are told apart by their place in the table read, so repeated ids are copies like others.
    The places are written once: how files are split, and so a place worked out again, can change
    with the executors alive.
    """
    rows = stored(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.col("_row").alias("row"))
    placed = rows.select(place.alias("_place"), "text")
    groups = simhash.near_duplicates(placed, ("_place",))
    first = groups.where(F.col("_place") == F.col("component_id")).select(F.col("_place.row").alias("_row"))
    return rows.join(first, "_row", "left_semi").select(*COLUMNS)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of training sequences with their token ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("language identification", known_language),
    ("near-duplicates", near_unique),
    ("packing", into_sequences),
]
#: Models and tokens are beyond SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
