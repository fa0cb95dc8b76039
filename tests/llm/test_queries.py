"""Registered queries and the pipeline on a small set of tables, against brute force."""

import re
import zlib

import numpy as np
import pytest
from llm import brute

import corpus_pipeline
from pixtrend.llm import queries, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    rows = brute.corpus(seed=9, n=260)
    toxic = set(range(0, 260, 4))
    rows = [(i, f"{t} scumword vileword" if i in toxic else t) for i, t in rows]
    items = [(i, " ".join(brute.alnum(brute.words(rng, 30)))) for i in range(6)]
    rows = [(i, f"{t}\n{items[i % 6][1]}" if i % 29 == 1 else t) for i, t in rows]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i % 9 != 0), int(i in toxic)) for i, _ in rows if i < 260 and i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(i, rng.normal(size=16).tolist(), i % 4) for i in range(400)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder, rows, items, toxic, vectors


def collect(spark, tables, name):
    return queries.QUERIES[name](spark, tables[0]).collect()


def test_every_operator_has_one_query():
    found = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert sorted(found) == list(range(1, 14))


def test_op1(spark, tables):
    want = {d: (n, len(k), ",".join(map(str, k))) for d, (n, k) in brute.kept_lines(tables[1]).items()}
    assert {r["doc_id"]: (r["n_lines"], r["n_kept"], r["kept_lines"]) for r in collect(spark, tables, "op1_line_dedup")} == want


def test_op2(spark, tables):
    got = collect(spark, tables, "op2_sharding")
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in tables[1]}
    for s in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["law"] for r in got} == {"key"} and all(r["grown_shard"] in (r["shard"], 16) for r in got)


@pytest.mark.parametrize("name,modulus,held", [("op3_quality_crf", 5, 0), ("op5_toxicity_pu", 3, 1)])
def test_op3_op5_shape(spark, tables, name, modulus, held):
    got = collect(spark, tables, name)
    limit = 0.3 if "quality" in name else 0.7
    assert len(got) == len(tables[1])
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)


def test_op4(spark, tables):
    got = sorted(str(tuple(r)) for r in collect(spark, tables, "op4_ngram_jaccard_join"))
    assert got == brute.similar_groups(tables[1], 3, 9, 10)


def test_op6(spark, tables):
    got = collect(spark, tables, "op6_substring_dedup")
    first, need = {}, set()
    for d, t in sorted(tables[1], key=lambda r: r[0]):
        w = brute.spaced(t)
        for i in range(len(w) - 50):
            if first.setdefault(tuple(w[i:i + 51]), d) != d:
                need.add(d)
    assert need <= {r["doc_id"] for r in got}


def test_op7(spark, tables):
    want = brute.decontaminate(tables[1], tables[2])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in collect(spark, tables, "op7_benchmark_decontamination")}
    assert got == want and any(v[1] for v in want.values())


def test_op8(spark, tables):
    import hashlib

    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.vocab_path("byte_bpe_50k.json"))
    texts = dict(tables[1])
    for r in collect(spark, tables, "op8_bpe"):
        text = texts[r["doc_id"]] or ""
        ids = lib.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op9(spark, tables):
    got = collect(spark, tables, "op9_multi_index_hashing")
    want = brute.nearest([(i, np.float32(v).tolist()) for i, v, _ in tables[4]], lambda q: q % 100 == 0, 10)
    assert len(got) == len(want)
    assert len({(r["query_id"], r["vec_id"]) for r in got} & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)


def test_op10(spark, tables):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.vocab_path("word_bpe_49k.json"))
    texts, at = dict(tables[1]), 0
    for r in sorted(collect(spark, tables, "op10_token_files"), key=lambda r: r["doc_id"]):
        ids = np.array([*lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pipeline_stage_by_stage(spark, tables):
    folder, rows, items, toxic, _ = tables
    docs = queries.table(spark, folder, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.materialise(stage(spark, docs, folder), f"test-{name}")
        outs.append({r["doc_id"]: r for r in docs.collect()})
        assert docs.columns == COLUMNS or name == "bpe"
    clean, lines, groups, cut, coded = outs
    assert not {i for i in toxic if i < 260} & set(clean) and {i for i, _ in rows} - toxic <= set(clean)
    kept = brute.kept_lines([(i, r["text"]) for i, r in clean.items()])
    for i, r in clean.items():
        left = "\n".join((r["text"] or "").split("\n")[k] for k in kept[i][1])
        if i in lines:
            assert (lines[i]["text"] or "") == left
            assert lines[i]["n_chars"] == (None if r["text"] is None else len(left))
        else:
            assert not left.strip() and brute.spaced(r["text"])
    want = brute.similar_groups([(i, r["text"]) for i, r in lines.items()], 5, 4, 5)
    assert sorted(groups) == sorted(int(w.split(",")[0][1:]) for w in want if w.split(",")[0][1:] == w.split(", ")[2][:-1])
    found = brute.decontaminate([(i, r["text"]) for i, r in groups.items()], items)
    assert set(cut) == set(groups)
    for i, (n_words, n_hit, _, _) in found.items():
        assert (cut[i]["text"] == groups[i]["text"]) == (n_hit == 0)
        assert len(brute.alnum(cut[i]["text"])) == n_words - n_hit
    assert all(r["exact"] and len(r["ids"]) == 4 * r["n_tokens"] for r in coded.values()) and set(coded) == set(cut)


def test_pipeline_with_nulls_repeats_clashes_and_nothing(spark, tables):
    folder = tables[0]
    rows = [(None, None, "en", None, None, 1, 2), (None, "no key at all here", None, "s", 5, 1, 2), (1, "same text twice over", "en", "s", 20, 1, 2),
            (1, "same text twice over", "en", "s", 20, 1, 2), (2, "", "en", "s", 0, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, items int, score int")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
        out.collect()
    assert corpus_pipeline.keep_one_of_each_group(spark, docs, folder).count() == 4
    assert corpus_pipeline.encode(spark, docs, folder).count() == 5


def test_rows_that_repeat_an_id_with_other_texts_stay(spark):
    rng = np.random.default_rng(4)
    a, b, c = (brute.words(rng, 40) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "w"), (1, None, "x"), (2, c, "x"), (3, c, "x"), (4, b, "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()), key=str)
    texts = [t for _, t, _ in got]
    assert sorted(texts, key=str) == sorted([a, b, None, c, "no id"], key=str)  # one of each text
    assert (2, c, "x") in got and (1, b, "x") not in got  # the first by its other columns
    again = sorted((tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, docs.repartition(7, "source"), "").collect()), key=str)
    assert again == got


def test_one_of_each_group_keeps_columns_of_any_name_and_type(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 7, "k", 1.5, {"a": 1}), (2, text, 8, "l", None, None), (3, "quite another text of its own", 9, None, 2.5, {}), (None, text, 1, "n", 0.0, {"b": 2}), (1, text, 6, "k", 1.5, {"a": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int, _key string, _first double, _row map<string,int>")
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns and got.schema["_row"].dataType == docs.schema["_row"].dataType
    kept = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert set(kept) == {1, 3, None}
    assert kept[3] == rows[2] and kept[None] == rows[3] and kept[1] in (rows[0], rows[4])
