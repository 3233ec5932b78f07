"""The registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import hard_negatives, mixing, topk, warc
from keelson.llm.cross_tokens import align_tokenizers, piece_bpe
from keelson.llm.decontaminate import with_leaks
from keelson.llm.html_text import extract_text
from keelson.llm.langid import fit_languages, identify_languages, in_fold
from keelson.llm.near_dup import near_duplicates
from keelson.llm.pitman_yor import pitman_yor
from keelson.llm.token_counts import count_edited
from keelson.llm.token_files import byte_bpe, read_token_files, token_folder, write_token_files
from keelson.llm.toxicity import fit_toxicity, score_toxicity
from keelson.plans.registry import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op7_near_duplicates")
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), token_folder(spark), byte_bpe()))


@query("op2_mix_sources", mixing.ORACLE)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 3, 1)
    model = fit_languages(docs.where(~held_out))
    return identify_languages(docs.drop("lang"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


@query("op6_warc", warc.ORACLE)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_warc(table(spark, sf_dir, "pages"), warc.warc_folder(spark))
    return warc.read_warc(index, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold("doc_id", 4, 2)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op9_top_k", topk.ORACLE)
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x.item_id)))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), items.alias("item_ids"), "leaks")


def revision() -> list:
    """Three edits of any text: a cut after a third, a new wording after two thirds, a line at the end."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")

    def edit(start, removed: int, inserted: str):
        return F.struct(start.cast("long").alias("start"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted"))

    return [edit(F.floor(size / 3), 40, ""), edit(F.floor(size * 2 / 3), 12, "as revised, it's"), edit(size, 0, "\nUpdated 2026.")]


@query("op4_edited_token_counts")
def op4_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edited(docs.withColumn("edits", F.array(*revision())), byte_bpe())


@query("op13_hard_negatives", hard_negatives.ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", noisy), F.col("vec_id") % 50 == 0)


@query("op12_cross_tokens")
def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())[0]


@query("op11_pitman_yor")
def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2), order=2)[0]
