"""A corpus pipeline in five stages; each calls one operator of ``epochal.llm``.

Every stage takes an empty table to an empty one.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. ``run`` applies them to the table documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochal.llm import bpe, mixing, near_dup, quality, toxicity
from epochal.llm.common import MADE, drop_folders, materialize, unused, work_dir
from epochal.llm.queries import learning_labels, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents, without the lines that failed.

    Null, empty and wordless texts are rejected; equal rows fare alike; further columns are kept as they are.
    """
    return quality.clean(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold, by a model learned from the labelled ones among them.

    Null and empty texts get the model's base score; without labels nothing is dropped; equal rows fare alike;
    a column named toxicity is kept as it is.
    """
    model = toxicity.learn(docs, learning_labels(spark, sf_dir))
    scored = toxicity.score(docs, model)
    return scored.where(~toxicity.is_toxic(scored[scored.columns[-1]])).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, a row with an id before one without.

    Of equal rows one stays, also if they have no id; rows that share an id but not their words are documents of
    their own; null and wordless texts are linked with nothing and stay.
    """
    row = unused("row", docs.columns)
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), work_dir(spark, "numbered"), "docs")
    verdict = near_dup.near_duplicates(numbered, words=5, percent=80, id_column=row)
    places = numbered.select(F.col(row).alias("doc_id"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row)).alias("place"))
    first = verdict.join(places, "doc_id").groupBy("component_id").agg(F.min("place").alias("place"))
    return numbered.join(first.select(F.col(f"place.{row}").alias(row)), row, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by probabilities that are raked to source, language and topic shares.

    Null sources, languages and texts are categories of their own; a document of a rare category may be drawn
    more than once; further columns are kept as they are.
    """
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids. Null and empty texts have no ids."""
    return bpe.encode(docs.select("doc_id", "source", "lang", "text"), tokenizer_path()).drop("text")


STAGES = [
    ("quality", quality_rules),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: No SQL: the encoder, the classifier and exact shingle similarity have none; tests/llm/test_pipeline.py checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's working folders go once its rows are written, its rows once the next one's are."""
    folder, before = work_dir(spark, "pipeline"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = len(MADE)
        docs = materialize(stage(spark, docs, sf_dir), folder, name)
        drop_folders(spark, before + MADE[made:])
        before = [f"{folder}/{name}"]
    return docs
