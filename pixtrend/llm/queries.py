"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.llm import bpe, fm_index, line_crf, line_dedup, merkle, multi_index, ngram_join, passage_chain, pii_bootstrap, prefix_trie, sharding, token_files, toxicity_pu
from pixtrend.llm.scratch import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def vocab_path(name: str) -> str:
    """Place of a public vocabulary file on the driver; only its tables are sent to tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


#: Prefix-filtered self-join over whole word strings, for DuckDB.
LINE_DEDUP_SQL = r"""
with line as (
  select doc_id, unnest(range(len(ls))) as line_no, unnest(ls) as line
  from (select doc_id, string_split(text, chr(10)) as ls from documents)
), word as (
  select doc_id, line_no, list_sort(list_filter(list_distinct(string_split_regex(lower(line), '[ \t\x0B\f\r]+')), lambda w: w <> '')) as s
  from line
), cls as (
  select s, len(s) as n, min({'d': doc_id, 'l': line_no}) as p, row_number() over (order by s) as c from word where len(s) > 0 group by s
), tok as (
  select c, n, unnest(s) as w from cls
), df as (
  select w, count(*) as df from tok group by w
), post as (
  select c, n, w, row_number() over (partition by c order by df, w) as pos from tok join df using (w)
), short as (
  select * from post where pos <= n - ((4 * n + 4) // 5) + 1
), cand as (
  select distinct a.c as a, b.c as b from short a join short b on a.w = b.w and a.c < b.c
  where 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), gone as (
  select distinct greatest(x.p, y.p) as p from cand join cls x on x.c = a join cls y on y.c = b
  where 9 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n)
), kept as (
  select p.d as doc_id, p.l as line_no from cls where p not in (select p from gone)
  union all select doc_id, line_no from word where len(s) = 0
)
select l.doc_id, l.n_lines, coalesce(k.n_kept, 0) as n_kept, coalesce(k.kept_lines, '') as kept_lines
from (select doc_id, count(*) as n_lines from line group by doc_id) l
left join (select doc_id, count(*) as n_kept, string_agg(cast(line_no as varchar), ',' order by line_no) as kept_lines from kept group by doc_id) k
using (doc_id)
"""


@register("op1_line_dedup", LINE_DEDUP_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that stay when later similar lines (Jaccard 0.8) go."""
    out = line_dedup.kept_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("d").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"),
                      F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept_lines"))


@register("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over shards 0 to 15 by rendezvous hashing of doc_id."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), [1.0] * 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard of 0.9 or more."""
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), 3, (9, 10))


@register("op3_quality_crf")
def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality from line labels of a conditional random field."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    out = line_crf.score(docs, model)
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op5_toxicity_pu")
def op5_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of documents from positive-unlabelled learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_pu.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    out = toxicity_pu.score(docs, model)
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document shares with an earlier one."""
    return passage_chain.shared_passages(table(spark, sf_dir, "documents"))


@register("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside any 10-word window of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fm_index.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@register("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.round_trip(docs, vocab_path("byte_bpe_50k.json"))
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op9_multi_index_hashing")
def op9_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth, by multi-index hashing."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@register("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as context-mixed blocks and read back."""
    folder = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), vocab_path("word_bpe_49k.json"), folder, end_id=2)
    out = token_files.read_token_files(spark, folder)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op11_prefix_trie")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of conversations rebuilt on the first turns of every twentieth."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns, 20, head, 3))


@register("op12_merkle_manifest")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document, checked against texts of which every second has lost its line ends."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    out = merkle.manifest(docs, F.when(odd == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@register("op13_pii_bootstrap")
def op13_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document: base patterns, and what bootstrapped contexts add."""
    out = pii_bootstrap.identifiers(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii_bootstrap.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii_bootstrap.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii_bootstrap.listed(F.col("spans")).alias("spans"))
