"""Documents to training files in five stages, each one an operator of ``keelson.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.columns import unused
from keelson.llm.decontaminate import with_leaks
from keelson.llm.langid import NONE, fit_languages, identify_languages
from keelson.llm.mixing import mixed_documents
from keelson.llm.near_dup import near_duplicates
from keelson.llm.token_files import byte_bpe, read_token_files, token_folder, write_token_files
from keelson.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def packed(docs: DataFrame) -> DataFrame:
    """The text, and whole rows as one column, so that new columns meet no name of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document"), "text")


def unpacked(found: DataFrame) -> DataFrame:
    return found.select("_document.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language stay; those without a text or a letter are rejected."""
    model = fit_languages(docs)
    if not model.languages:  # nothing to learn from: only what has no letter is rejected
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return unpacked(identify_languages(packed(docs), model).where(F.col("lang_pred") != NONE))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id (a missing id comes last).

    Groups are made of texts, not of ids: every distinct pair of id and text has a number of its own (a 64-bit hash), so
    rows that share an id, or have none, are linked and kept each by its own text. Rows equal in both are one
    document; of those that differ elsewhere the greatest under a hash of all columns stays. So do texts without words, one per id.
    """
    row, best, kept = unused(docs.columns, "row", "best", "kept")
    numbered = docs.withColumn(row, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    groups = near_duplicates(numbered, id_col=row, percent=80).select(row, "component_id").distinct()
    ids = numbered.select(row, "doc_id").distinct().withColumnRenamed(row, kept)
    first = groups.join(ids, groups[row] == ids[kept]).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", kept)).alias("first"))
    stay = numbered.join(first.select(F.col(f"first.{kept}").alias(kept)).hint("shuffle_hash"), F.col(row) == F.col(kept), "left_semi")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = stay.groupBy(row).agg(F.max_by(F.struct(*columns), F.xxhash64(*columns)).alias(best))
    return one.select(*[F.col(best)[c].alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return unpacked(with_leaks(packed(docs), benchmark).where(F.size("leaks") == 0))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents left out, repeated or, on the line, cut."""
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in range-coded files; the result is what reading the files back gives per document."""
    return read_token_files(write_token_files(docs, token_folder(spark), byte_bpe()))


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("token_files", token_files)]
ORACLE_SQL = None  # fitted models, hashing and tokenizers; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read back before the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
