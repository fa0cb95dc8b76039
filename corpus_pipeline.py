"""Cleaning pipeline over ``documents``: every stage works on all that the one
before has kept, and its output is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.llm import bpe, fm_index, line_dedup, ngram_join, toxicity_pu
from pixtrend.llm.queries import table, vocab_path
from pixtrend.llm.scratch import materialise

#: Score from which a document counts as toxic.
TOXIC = 0.7
#: Near copies: five-word shingles, Jaccard 0.8.
SHINGLE, SIMILARITY = 5, (4, 5)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores below ``TOXIC``."""
    model = toxicity_pu.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity_pu.score(docs, model, out="_toxicity").where(F.col("_toxicity") < TOXIC).drop("_toxicity")


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that repeat or nearly repeat an earlier one.  A
    document that had words and lost its last one goes; ``n_chars`` follows."""
    out = line_dedup.dedup_lines(aside(docs))
    emptied = (F.col("n_kept") < F.col("n_lines")) & (F.trim(F.regexp_replace("text", r"\s", "")) == "")
    return restored(out.where(F.col("text").isNull() | ~emptied), "text", docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id.
    Rows without an id stay.  Rows that repeat an id compete as any others do:
    of equal texts one stays, the first by a hash of its other columns; other texts than
    the first by hash count as ids behind all others."""
    packed = aside(docs)
    known = packed.where("doc_id is not null").withColumn("_h", F.xxhash64("text"))
    repeats = materialise(known.groupBy("doc_id").agg(F.min("_h").alias("_first"), F.max("_h").alias("_last")).where("_first < _last"), "repeats")
    later = F.xxhash64("doc_id", "_h").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    keyed = (known.join(repeats.select("doc_id", "_first"), "doc_id", "left")
             .withColumn("_key", F.when(F.col("_h") != F.col("_first"), later).otherwise(F.col("doc_id").cast("long"))))
    nameless = packed.where("doc_id is null")
    rows = keyed.select(F.col("_key").alias("doc_id"), "text").unionByName(nameless.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    groups = materialise(ngram_join.similar_groups(rows, SHINGLE, SIMILARITY), "groups")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    one = keyed.join(kept, "_key", "left_semi").groupBy("_key").agg(F.min_by(F.struct("doc_id", "text", "_rest"), F.xxhash64(F.to_json("_rest"))).alias("_row"))
    out = one.select("_row.*").unionByName(nameless)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c) for c in docs.columns])


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that hold a benchmark window."""
    return restored(fm_index.decontaminate(aside(docs), table(spark, sf_dir, "benchmark")), "clean_text", docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, with the text decoded from them."""
    out = bpe.round_trip(docs.select("doc_id", "text"), vocab_path("byte_bpe_50k.json"))
    return out.select("doc_id", "text", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


def aside(docs: DataFrame) -> DataFrame:
    """Key and text, all other columns in one that no operator's names can clash with."""
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[c for c in docs.columns if c not in ("doc_id", "text")]).alias("_rest"))


def restored(out: DataFrame, text: str, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the new text and its ``n_chars``."""
    new = {"doc_id": F.col("doc_id"), "text": F.col(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("_rest").getField(c)).alias(c) for c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("bpe", encode),
]

#: A trained classifier decides in the first stage, which SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
