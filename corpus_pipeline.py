"""A training corpus from raw documents, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from tripflow.llm.queries import digest, vocabulary
from tripflow.llm.words import documents, written


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with the length of a changed text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. NULL and empty texts have no words and
    go; every row is judged on its own, so repeated rows and ids, NULL ids too, stay
    or go alike; no documents give none."""
    return quality_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines of windows that occur earlier (by id,
    then text: of repeated rows the first keeps its lines). A NULL text stays NULL,
    an empty one empty; rows without an id stay; no documents give none."""
    return _with_text(line_dedup.dedup_lines(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked by five-word shingles at 80 %: the
    one with the smallest id. Rows that share an id are told apart by a hash of
    id and text, so an unlike text under the same id stays. Documents without an
    id are in no group."""
    rows = docs.select(F.struct("*").alias("_row")).where("_row.doc_id IS NOT NULL")
    rows = rows.withColumn("_key", F.xxhash64("_row.doc_id", "_row.text"))
    groups = jaccard_join.join_groups(rows.select("_key", "_row.text"), n=5, percent=80, id_col="_key")
    ids = rows.select("_key", F.col("_row.doc_id").alias("_doc")).distinct()
    member = groups.select("_key", "component_id").distinct().join(ids.hint("merge"), "_key")
    first = member.groupBy("component_id").agg(F.min(F.struct("_doc", "_key")).alias("m")).select("m._key")
    kept = mixing.first_row(docs.columns, ("doc_id", "text"))
    known = rows.join(first.hint("merge"), "_key", "left_semi").groupBy("_key").agg(kept).select("_row.*")
    return known.unionByName(docs.where("doc_id IS NULL"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time words of a document are used, with those
    words. A document of a source that is used in part may have no row, and
    neither has one without words (NULL, empty or white space). A NULL source is a
    source; rows of one id, text and source are put together; no documents give
    none."""
    return _with_text(mixing.mixed_documents(docs, mixing.mix(docs)), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, and a digest of their decoding. A NULL
    or empty text has no ids; one row a row, repeated or without an id; no documents
    give none."""
    coded = bpe.encode_documents(docs, vocabulary())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", digest(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_to_targets),
    ("bpe", encode),
]

#: The verdict of a fitted model and a pseudorandom mix are not SQL; the tests
#: hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
