"""Merkle manifests against a plain tree, and their edge cases."""

import numpy as np
import pytest
from llm import brute

from pixtrend.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def want(rows, fanout=3):
    return brute.merkle([(d, s, lang, n, t) for d, t, lang, s, n, *_ in rows], fanout)


def got(df):
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect()], key=str)


def run(spark, folder):
    return queries.QUERIES["op12_merkle_manifest"](spark, folder)


def corpus(n, sources):
    rng = np.random.default_rng(n)
    return [(i, brute.words(rng, 12) + ("\n" if i % 3 else ""), "en", f"s{int(rng.integers(sources))}" if i % 4 else "s0", i) for i in range(n)]


@pytest.mark.parametrize("n,sources", [(1, 1), (2, 2), (27, 1), (28, 1), (163, 11)])
def test_query_equals_a_plain_tree(spark, tmp_path, n, sources):
    rows = corpus(n, sources)
    assert got(run(spark, write(spark, tmp_path, rows))) == want(rows)


def test_nulls_ties_repeats_long_and_clashing_columns(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "x\n", None, None, 2), (5, "a\nb", "en", "é", 3), (5, "a\nb", "en", "é", 3), (5, "other", "en", "é", 5),
            (7, "", "", "", 0), (9, "word\n" * 60_000, "fr", "Z", None), (-4, "ü€\U0001F600\n", "de", "z", 4), (11, "null", "-", "-", 1)]
    rows = [(*r, "clash", 1) for r in rows]
    folder = write(spark, tmp_path, rows, SCHEMA + ", grp string, pos int")
    assert got(run(spark, folder)) == want(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, write(spark, tmp_path, [])).collect() == []


@pytest.mark.parametrize("fanout", [2, 5])
def test_other_fanouts_and_untampered_tables_verify(spark, fanout):
    from pyspark.sql import functions as F

    rows = corpus(40, 3)
    out = merkle.manifest(spark.createDataFrame(rows, SCHEMA), F.col("text"), fanout)
    seen = out.collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in seen)
    assert {(r["doc_id"], r["leaf"], r["root"], r["proof_sha256"]) for r in seen} == {(w[0], w[1], w[3], w[4]) for w in want(rows, fanout)}
    assert {r["source"] for r in seen} == {r[3] for r in rows}


def test_a_hot_source_is_numbered_over_ranges(spark):
    from pixtrend.llm.ranking import numbered

    rows = [("hot" if i % 3 else f"s{i}", i % 50) for i in range(3000)]
    out = numbered(spark.createDataFrame(rows, "g string, v int").repartition(8), "g", ["v"]).collect()
    for g in {r["g"] for r in out}:
        at = sorted((r["pos"], r["v"]) for r in out if r["g"] == g)
        assert [p for p, _ in at] == list(range(len(at))) and [v for _, v in at] == sorted(v for _, v in at)
