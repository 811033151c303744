"""Queries of the language-model data problems (3, 4, 5, 8, 9, 10) and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import bpe, dedup, lookalike, mojibake, packing, quality
from noticeflow.operators.snapshot_diff import buckets_for
from noticeflow.storage import materialize, read, remove, shared_folder

TOKENIZER = "byte_bpe_50k"


def _rows(df: DataFrame, order) -> DataFrame:
    id = F.col("row_id") if "row_id" in df.columns else F.lit(0).cast("bigint")
    return dedup.rows_of(df, "natural_key", "organization_id", F.coalesce("title_normalized", "title"), "announced_date", order, id)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Batch rows that repeat an accepted notice or an earlier row of the batches."""
    named = ["natural_key", "organization_id", "title", "title_normalized", "announced_date"]
    order = F.struct(F.coalesce("batch_no", F.lit(2**31 - 1)).alias("batch"), F.coalesce("row_id", F.lit(2**63 - 1)).alias("row"))
    batch = _rows(read(spark, d, "tender_batch").select("row_id", "batch_no", *named), order).where("id is not null")
    history = _rows(read(spark, d, "tender").select(*named), F.struct(F.lit(-(2**31)).alias("batch"), F.lit(0).cast("bigint").alias("row")))
    at = f"{shared_folder(spark)}/accepted-{uuid.uuid4().hex}"
    index = dedup.AcceptedIndex(spark, at, buckets=buckets_for(history))
    index.append(history, "history")
    # every row carries its place in the order of arrival, so the batches that lie here are judged as one
    found = materialize(index.judge(batch, "batches"))
    remove(spark, at)
    return found.withColumnRenamed("id", "row_id")


def _examined(spark: SparkSession, d: str) -> DataFrame:
    tender, extraction = read(spark, d, "tender"), read(spark, d, "extraction_result")
    corpus = read(spark, d, "documents").select("text").unionByName(tender.select(F.col("title").alias("text"))).unionByName(extraction.select("text"))
    records = tender.select(F.lit("tender").alias("table_name"), F.col("natural_key").alias("record_key"), F.col("title").alias("text"))
    records = records.unionByName(extraction.select(F.lit("extraction_result").alias("table_name"), F.col("id").cast("string").alias("record_key"), "text"))
    return mojibake.examine(records.where("record_key is not null and text is not null"), mojibake.gather(corpus))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Tenders and extracted texts with characters that come from a wrong decoding."""
    return _examined(spark, d).where("garbled").select("table_name", "record_key")


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    """The garbled records with their text as far as it could be restored."""
    return _examined(spark, d).where("garbled").select("table_name", "record_key", "restored", "whole")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of an organization's tenders whose normalized titles look the same without being the same."""
    tender = read(spark, d, "tender")
    # what decoding left (controls, replacement and private-use characters) marks garbled titles, which are no cases
    sound = ~F.col("title_normalized").rlike("[\u0080-\u0084\u0086-\u009f\ufffd\ue000-\uf8ff]")
    pairs = lookalike.same_looking_pairs(tender, "natural_key", "organization_id", "title_normalized", keep=sound)
    return pairs.select(F.col("a").alias("natural_key_a"), F.col("b").alias("natural_key_b"))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every tender's normalized title (title_form) and title as it was published (title_own_form) in one form."""
    return lookalike.canonical_columns(read(spark, d, "tender"), "natural_key", {"title_normalized": "title_form", "title": "title_own_form"})


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return bpe.encode_column(read(spark, d, "documents"), "doc_id", "text", TOKENIZER).withColumnRenamed("id", "doc_id")


def _containers(spark: SparkSession, d: str) -> DataFrame:
    spec = read(spark, d, "container_spec").where("tokenizer is not null").select("container_id", "capacity_tokens", "tokenizer").collect()  # a few kinds of container
    packed = packing.pack(read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit(0).alias("size")).limit(0), {})
    for name in sorted({r["tokenizer"] for r in spec}):
        counted = bpe.encode_column(read(spark, d, "documents"), "doc_id", "text", name, counts_only=True)
        items = materialize(counted.withColumnRenamed("tokens", "size"))
        part = packing.pack(items, {r["container_id"]: r["capacity_tokens"] for r in spec if r["tokenizer"] == name})
        packed = packed.unionByName(part)
    return packed


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document, or of each of its pieces, for each kind of container."""
    return _containers(spark, d).withColumnRenamed("id", "doc_id")


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, tokens in them, and the fewest containers that could hold them."""
    spec = read(spark, d, "container_spec").select("container_id", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    each = _containers(spark, d).where("container is not null").groupBy("container_id", "container").agg(F.sum("tokens").alias("tokens"))
    whole = each.groupBy("container_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    return whole.join(spec, "container_id").select("container_id", "capacity", "containers", "tokens", "fullest", F.ceil(F.col("tokens") / F.col("capacity")).alias("at_least"))


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Text statistics and label of every document."""
    got = quality.describe(read(spark, d, "documents"), "doc_id", "text", read(spark, d, "common_word"))
    return got.withColumnRenamed("id", "doc_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with visible text that is mostly not prose."""
    return p10_statistics(spark, d).where("label not in ('prose', 'empty')").select("doc_id")


QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p4_restored": p4_restored, "p5_found": p5_found, "p5_forms": p5_forms, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill, "p10_found": p10_found, "p10_statistics": p10_statistics}
ORACLE: dict[str, str] = {}
