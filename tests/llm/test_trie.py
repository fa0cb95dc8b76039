"""Prefix trie against a plain one, with long, hot and odd conversations."""

import numpy as np
import pytest
from llm import brute

from pixtrend.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    out = queries.QUERIES["op11_prefix_trie"](spark, str(folder)).select(*NAMES)
    return sorted([tuple(r) for r in out.collect()], key=str)


def conversations(n, seed):
    """Few different turns, so that many prefixes are shared at all depths."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        length = int(rng.integers(1, 7))
        rows += [(c, t, ["user", "assistant"][t % 2], " ".join(["a", "b c", "d"][: int(rng.integers(1, 3))])) for t in range(length)]
    return rows


def test_shared_prefixes(spark, tmp_path):
    rows = conversations(150, 4)
    assert run(spark, tmp_path, rows) == brute.trie(rows)


def test_mostly_single(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(c, t, "user", brute.words(rng, 6)) for c in range(90) for t in range(3)]
    assert run(spark, tmp_path, rows) == brute.trie(rows)


def test_nulls_repeats_ties_long_and_clashing(spark, tmp_path):
    rows = conversations(40, 2)
    rows += [(100, None, None, None), (100, None, "user", ""), (100, 3, "user", "x y"), (100, 3, "user", "x y"), (100, 3, "user", "a"), (100, -1, None, "z"),
             (None, 1, "user", "lost"), (61, 0, "user", "no base"), (65, 0, "user", "one"), (203, 5, "user", "word " * 50_000), (204, 5, "user", "word " * 50_000)]
    rows += [(c, 0, "user", "copy") for c in range(300, 420)]
    wide = [(*r, 7, "x") for r in rows]
    assert run(spark, tmp_path, wide, SCHEMA + ", d0 int, _block string") == brute.trie(rows)


def test_conversation_longer_than_a_block_and_its_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(c, t, "user", f"turn {t % 7} {c if t > 90 else ''}") for c in (40, 41, 43) for t in range(120)]
    rows += [(60, t, "user", "again") for t in range(70)]
    assert run(spark, tmp_path, rows) == brute.trie(rows)


def test_full_sketch_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MIN_WIDTH", 64)
    monkeypatch.setattr(prefix_trie, "MAX_WIDTH", 64)
    rows = conversations(60, 8) + [(c, 0, "user", f"own {c}") for c in range(500, 560)]
    assert run(spark, tmp_path, rows) == brute.trie(rows)


@pytest.mark.parametrize("rows", [[], [(0, 0, "user", "hi there")]])
def test_empty_and_one(spark, tmp_path, rows):
    assert run(spark, tmp_path, rows) == brute.trie(rows)


def test_sketch_never_calls_a_shared_prefix_single(spark):
    rows = spark.range(4000).selectExpr("id div 2 as d0", "id div 2 as d1", "cast(0 as bigint) as p0", "cast(0 as bigint) as p1")
    lone = spark.range(5000, 7000).selectExpr("id as d0", "id as d1", "cast(0 as bigint) as p0", "cast(0 as bigint) as p1")
    out = prefix_trie.screened(rows.unionByName(lone)).selectExpr("d0 >= 5000 as lone", "single").groupBy("lone", "single").count().collect()
    n = {(r["lone"], r["single"]): r["count"] for r in out}
    assert (False, True) not in n and n[(True, True)] > 1900
