"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a table, which is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.llm import blob_secrets, language_fusion, nnls_packing, partenum_join, toxicity
from incident_analytics.llm.common import new_folder, read, written
from incident_analytics.llm.queries import WORD_VOCABULARY, lexicon_of

SHINGLE_WORDS = 5
SIMILARITY = Fraction(8, 10)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the evidence agrees on go."""
    found = language_fusion.identify(docs, "text", "lang", "source")
    return found.where("accepted").select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more go."""
    scored = toxicity.score(docs, lexicon_of(spark, sf_dir), out="_score")
    return scored.where(F.col("_score") < toxicity.CUT_SCORE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the row with the least id stays (null ids last).

    A row's key is a digest of its id and text, so a row goes only for a link of its own:
    another text with the same id stays unless it is linked too. Rows equal in both become
    one; empty texts link with nothing and stay.
    """
    folder = new_folder(spark, "stage-join")
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():  # an id is a row's key
        joined = partenum_join.join(docs, SHINGLE_WORDS, SIMILARITY)
        gone = written(joined.where("component_id <> doc_id").select("doc_id"), f"{folder}/gone")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select("doc_id", "text", key.alias("_key"))
    joined = written(partenum_join.join(keyed, SHINGLE_WORDS, SIMILARITY, key="_key"), f"{folder}/joined")
    copies = written(joined.groupBy("_key").agg(F.count("*").alias("n"), F.first("component_id").alias("group")), f"{folder}/copies")
    linked = copies.join(copies.groupBy("group").count().where("count > 1").select("group"), "group")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_key")
    placed = written(keyed.drop("text").join(linked.select("_key", "group"), "_key").select("group", place.alias("place")).distinct(), f"{folder}/placed")
    stay = placed.groupBy("group").agg(F.min("place").alias("first"))
    gone = placed.join(stay, "group").where("place <> first").select("place.doc_id", "place._key")
    gone = written(gone, f"{folder}/gone").select(F.col("doc_id").alias("_id"), "_key")

    name = next(n for n in ("_key" + "_" * i for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    whole, repeated = docs.withColumn(name, key), written(copies.where("n > 1").select("_key"), f"{folder}/repeated")
    kept = whole.join(gone, (whole[name] == gone["_key"]) & whole["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    same = kept[name] == repeated["_key"]
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(once).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    masked = blob_secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return nnls_packing.pieces(docs, WORD_VOCABULARY)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: Trained models and tokenizers are part of the stages, so SQL can't state the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
