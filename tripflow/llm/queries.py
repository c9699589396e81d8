"""Registered queries of the training-data operators, and their SQL.

Each ``opN_<name>`` applies its operator to the whole table and derives the
digest columns from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from tripflow.llm import bpe, html_text, jaccard_join, line_dedup, lm_score, mixing, nearest, periodic_runs, quality_classifier, quality_rules, suffix_dedup, token_files, vector_codes
from tripflow.llm.words import crc_mod, documents, written
from tripflow.session import scratch_path


def vocabulary() -> str:
    """The public tokenizer's file; its folder is not part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_bytes(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.coalesce(crc_mod("doc_id", 10), F.lit(0))
    held_out = fold == 0
    folds = F.when(held_out, lm_score.SCORED).when(fold == 1, lm_score.DELETED).otherwise(lm_score.KEPT)
    out = lm_score.score_documents(documents(spark, sf_dir), folds)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"), "text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_groups(documents(spark, sf_dir), n=3, percent=90)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.taken(mixing.mix(documents(spark, sf_dir)))
    return out.select(F.col("_id").alias("doc_id"), "source", "size", "source_size", "target", "taken", "first_shard", "last_shard")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(documents(spark, sf_dir), vocabulary())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = quality_rules.votes(documents(spark, sf_dir)).withColumn("doc_id", F.col("row.doc_id")).drop("row")
    voted = written(voted, "quality_votes")
    judged = quality_rules.judge(voted, quality_rules.learn(voted))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod("doc_id", 4), F.lit(0)) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs.where(~held_out), labels.where(~held_out))
    out = quality_classifier.score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", vector_codes.code_text(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_files")
    token_files.write_files(documents(spark, sf_dir), vocabulary(), folder, end_id=1)
    out = token_files.read_files(spark, folder)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = periodic_runs.planted(documents(spark, sf_dir))
    # The longest run, the first of equals: the least by these keys.
    key = lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    best = F.array_min(F.transform("runs", key))
    out = periodic_runs.find_runs(texts).withColumn("_best", best)
    length, period = -F.col("_best.n"), F.col("_best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        digest(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_lm_score": op2_lm_score,
    "op3_html_text": op3_html_text,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_mix_sources": op6_mix_sources,
    "op7_nearest": op7_nearest,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_files": op12_token_files,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": line_dedup.SQL,
    "op7_nearest": nearest.SQL,
    "op11_vector_codes": vector_codes.SQL,
}
