"""Sharding, BPE, token files, classifiers and vectors."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm import brute

from pixtrend.llm import bpe, line_crf, multi_index, sharding, token_files, toxicity_pu
from pixtrend.llm.queries import fold, vocab_path

SCHEMA = "doc_id long, text string"
TEXTS = ["It's 12 o'clock,\n\n  we'll go ", "naïve ÉCOLE ﬁ 你好 🙂 ​ ", "<|endoftext|> a<|endoftext|>b <|end", "a" * 900, "ab " * 3000, "",
         " ", "\t\r\n\x1c\x1d x\x85y z", "İΣς ſ", "ﷺ²½Ⅻ٣"]


def test_shards_move_only_into_the_new_one(spark):
    rows = [(i, f"text {i}" * (i % 5)) for i in range(3000)] + [(None, "no key"), (7, None), (7, None), (7, None), (8, "é")]
    got = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "3 as shard"), [1.0] * 16).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r["grown_shard"] in (r["shard"], 16)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by) == 16
    moved = sum(r["grown_shard"] == 16 for r in got) / len(got)
    assert 0.03 < moved < 0.09
    want = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == want
    assert len({r["shard"] for r in got if r["doc_id"] == 7}) == 1
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA), [1.0, 2.0]).count() == 0


def test_shard_shares_follow_the_weights(spark):
    df = spark.range(8000).select(sharding.rendezvous_shard(__import__("pyspark.sql.functions", fromlist=["col"]).col("id"), [1.0, 3.0]).alias("s"))
    assert 0.70 < df.where("s = 1").count() / 8000 < 0.80
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(df.s, [1.0, 0.0])


def _random_texts(n=600):
    rng = np.random.default_rng(4)
    pools = [range(32, 127), range(0, 64), range(0xA0, 0x250), range(0x370, 0x500), range(0x2000, 0x2070), range(0x3040, 0x3200), range(0x1F600, 0x1F650)]
    return ["".join(chr(int(rng.choice(pools[int(rng.integers(len(pools)))]))) for _ in range(int(rng.integers(0, 60)))) for _ in range(n)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocab_path("byte_bpe_50k.json"))
    texts = TEXTS + _random_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None), (0, texts[0])], SCHEMA).selectExpr("*", "1 as decoded")
    got = bpe.round_trip(df, vocab_path("byte_bpe_50k.json")).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == lib.decode(want, skip_special_tokens=False) == (r["text"] or "")
    again = bpe.decode(bpe.encode(df.drop("decoded"), vocab_path("byte_bpe_50k.json")), vocab_path("byte_bpe_50k.json"))
    assert again.where("decoded <> coalesce(text, '')").count() == 0
    assert bpe.round_trip(df.limit(0), vocab_path("byte_bpe_50k.json")).count() == 0


def test_bpe_scan_and_heap_agree():
    enc = bpe.Encoder(bpe.Vocabulary(vocab_path("byte_bpe_50k.json")))
    rng = np.random.default_rng(0)
    for _ in range(200):
        raw = bytes(rng.integers(97, 103, int(rng.integers(1, 60))).tolist())
        assert enc.scan(raw) == enc.heap(raw)


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = vocab_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    texts = TEXTS + _random_texts() + [chr(c) + "a's" for c in range(0x500)]
    enc = token_files.WordEncoder(open(path, encoding="utf-8").read())
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_blocks_round_trip_and_checksum():
    rng = np.random.default_rng(0)
    blocks = [np.array([0]), np.full(300, 65534), np.arange(8192), np.zeros(8192), rng.integers(0, 65535, 5000), rng.zipf(1.3, 8192) % 5000]
    blocks = [b.astype(np.uint16) for b in blocks]
    coded = token_files.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, token_files.decode_blocks(coded, [len(b) for b in blocks]), strict=True))
    alone = token_files.encode_blocks(blocks[-1:])[0]
    assert alone == coded[-1] and len(alone) < 2 * len(blocks[-1])  # blocks are independent
    data = bytearray(token_files.pack_segments([([1, None], [blocks[4], blocks[0]])])[0])
    assert token_files.unpack_segments([bytes(data)])[0][0] == [1, None]
    data[-2000] ^= 1
    with pytest.raises(ValueError):
        token_files.unpack_segments([bytes(data)])


def test_token_files_in_key_order(spark, tmp_path):
    from tokenizers import Tokenizer
    path = vocab_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    rows = [(i, brute.words(rng, 200)) for i in range(300)] + [(300, None), (301, ""), (302, "long " * 20000), (5, rows5 := "same key")]
    token_files.write_token_files(spark.createDataFrame(rows, SCHEMA).repartition(7), path, str(tmp_path / "t"), part_bytes=60_000)
    got = token_files.read_token_files(spark, str(tmp_path / "t")).collect()
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(i for i, _ in rows)
    want = {(i, np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t in rows}
    assert {(r["doc_id"], r["ids"]) for r in got} == want and rows5
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), path, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def _labelled(n=900):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(n):
        lines = [brute.words(rng, int(rng.integers(5, 40)), 500) for _ in range(int(rng.integers(1, 6)))]
        bad, toxic = i % 5 == 0, i % 4 == 0
        if bad:
            lines = [line.upper().replace(" ", "!! ") for line in lines]
        if toxic:
            lines[0] += " nastyword horrid" if i % 8 else " horridly"
        docs.append((i, "\n".join(lines)))
        if i % 3:
            labels.append((i, int(not bad), int(toxic)))
    return docs + [(n, None), (n + 1, ""), (n + 2, "w1 " * 30000), (None, "w3 w4")], labels + [(None, 1, 1), (n, None, None), (3 * n, 1, 0)]


def test_quality_and_toxicity_on_held_out_documents(spark):
    docs, labels = _labelled()
    d = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' as score")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    quality = line_crf.score(d, line_crf.fit(d, lab, fold(5) != 0), lines="good").withColumn("held", fold(5) == 0).collect()
    toxic = toxicity_pu.score(d, toxicity_pu.fit(d, lab, fold(3) != 1)).withColumn("held", fold(3) == 1).collect()
    assert len(quality) == len(toxic) == len(docs)
    assert all(0 <= r["score"] <= 1 for r in quality + toxic)
    held_q = [r for r in quality if r["held"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 5 != 0) for r in held_q]) > 0.97
    assert all(len(r["good"]) == len((r["text"] or "").split("\n")) for r in held_q)
    held_t = [r for r in toxic if r["held"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held_t]) > 0.95


def test_classifiers_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for m in (line_crf, toxicity_pu):
        model = m.fit(d, none, fold(5) != 0)
        assert m.score(d, model).count() == 2 and m.score(d.limit(0), model).count() == 0


def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(0)
    unary, trans = rng.normal(size=6), rng.normal(size=(2, 2))
    first = np.array([0, 4, 4, 6])
    good, pairs, z = line_crf.forward_backward(unary, trans, first)
    total = np.zeros((2, 2))
    for d, (i, j) in enumerate(zip(first, first[1:], strict=False)):
        if i == j:
            continue
        weight, marginal, trans_count = 0.0, np.zeros(j - i), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(j - i)):
            e = np.exp(sum(unary[i + t] * v for t, v in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            weight += e
            marginal += e * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                trans_count[a, b] += e
        assert np.allclose(good[i:j], marginal / weight) and np.isclose(z[d], np.log(weight))
        total += trans_count / weight
    assert np.allclose(pairs, total)


def test_line_features_of_odd_texts():
    x, size, first = line_crf.line_features(pa.array(["a\n\nb", None, "", "\n", "x"]))
    assert first.tolist() == [0, 3, 3, 3, 4, 5] and size.tolist() == [1, 0, 1, 0, 1] and np.isfinite(x).all()


def test_multi_index_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 32))
    rows = [(i, (centres[i % 8] + 0.3 * rng.normal(size=32)).tolist()) for i in range(2000)]
    rows += [(2100 + i, rows[0][1]) for i in range(300)]  # a hot vector: ties by id
    odd = [(100_000, None), (100_100, [0.0] * 32), (100_200, [float("nan")] * 32), (100_300, [1.0, None] * 16), (None, rows[1][1]), (100_400, [1.0, 2.0]), (100, rows[100][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    import pyspark.sql.functions as F
    report: dict = {}
    got = [tuple(r) for r in multi_index.search(df, F.col("vec_id") % 100 == 0, 10, report=report).collect()]
    want = brute.nearest(rows + [odd[-1]], lambda q: q % 100 == 0, 10)
    assert len(got) == len(want) and report["bits"] == 256
    recall = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len(want)
    assert recall >= 0.95
    exact = {(q, v): s for q, _, v, s in want}
    assert all(np.isclose(s, exact[q, v], rtol=1e-12) for q, _, v, s in got if (q, v) in exact)
    assert [r[2] for r in sorted(got) if r[0] == 0] == list(range(2100, 2110))
    few = multi_index.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 100 == 0, 10).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, 1), (0, 2)]
    assert multi_index.search(df.limit(0), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_multi_index_with_repeated_candidates(spark):
    import pyspark.sql.functions as F
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(200)]
    near = (np.array(rows[0][1]) + 0.01).tolist()
    rows += [(300, near)] * 60 + [(301, (np.array(near) + 0.01 * i).tolist()) for i in range(60)]  # equal rows, and many rows of one id
    got = multi_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 10).collect()
    best: dict = {}
    for i, v in rows[1:]:
        best[i] = min(best.get(i, 1e9), float(np.linalg.norm(np.array(v) - np.array(rows[0][1]))))
    want = sorted((d, i) for i, d in best.items())[:10]
    got = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])], {r["vec_id"]: r["score"] for r in got}
    assert len(got[0]) == len(got[1]) == 10 and got[0][:2] == [300, 301]
    assert len({i for _, i in want} & set(got[0])) >= 9  # the radius holds nearly all
    assert all(np.isclose(d, best[i]) for i, d in got[1].items())


def test_tables_return_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 65536, (400, 16)).astype(np.uint16)
    codes[200:] = codes[:200]
    codes[200:, 3] ^= 5
    tables = multi_index.Tables(codes)
    for r in (0, 2, 17, 40, 110):
        q = codes[int(rng.integers(400))]
        far = np.bitwise_count(codes ^ q).sum(1)
        assert tables.within(q, r).tolist() == np.flatnonzero(far <= r).tolist()
