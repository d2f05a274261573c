"""The registered queries of the training-data operators: thin digests of each operator's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, filter_audit, fingerprints, language_id, mixing, near_dup, quality, token_store, toxicity, url_filter, warc
from .common import id_remainder, work_dir


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, tokenizer_path(), work_dir(spark, "tokens"), end_id=1, vocabulary=49_408)
    # digests without Python: a second worker beside the reading one would come to hold an encoder of its own
    ids = store.read(docs.select(F.col("doc_id").cast("long").alias("doc_id")), wide=True)
    n = (F.octet_length("ids") / F.col("width")).cast("long")
    return ids.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def learning_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may teach: rows whose crc32(doc_id) mod 3 is not 1."""
    return _table(spark, sf_dir, "labels").where(id_remainder("doc_id", 3) != 1)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_table(spark, sf_dir, "pages"), work_dir(spark, "warc"), min_bytes=0)
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), query=F.col("id") % 50 == 0, k=5)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.weigh(_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("copies", "probability")})


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    profiles = language_id.profile_arrays(language_id.learn(docs.where(~held_out)))
    return language_id.predict(docs, profiles, keep={"held_out": held_out})


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, learning_labels(spark, sf_dir))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        toxicity.is_toxic(F.col("toxicity")).cast("int").alias("predicted"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.run(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.compare(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_ann": op2_ann,
    "op3_quality": op3_quality,
    "op4_url": op4_url,
    "op5_bpe": op5_bpe,
    "op6_mixing": op6_mixing,
    "op7_token_store": op7_token_store,
    "op8_language": op8_language,
    "op9_toxicity": op9_toxicity,
    "op10_near_dup": op10_near_dup,
    "op11_filter_audit": op11_filter_audit,
    "op12_fingerprints": op12_fingerprints,
    "op13_alignment": op13_alignment,
}

#: The rest has no SQL: learned models, exact encodings, connected components and binary formats.
ORACLES: dict[str, str] = {"op1_warc": warc.sql(), "op3_quality": quality.sql(), "op4_url": url_filter.sql(), "op6_mixing": mixing.sql(), "op11_filter_audit": filter_audit.sql()}
