"""Line dedup, n-gram join, passages and decontamination against brute force."""

import numpy as np
import pytest
from llm import brute

from pixtrend.llm import fm_index, line_dedup, ngram_join, passage_chain
from pixtrend.llm import words as W
from pixtrend.llm.components import connected_components

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200), (200, 300), (None, 5)]
    got = {r["v"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join_equals_brute_force(spark, rows, k, num, den):
    odd = [*rows, (None, rows[3][1]), (None, "lonely words without a key"), (3, rows[3][1]), (4, "another text under a used key")]
    got = ngram_join.similar_groups(spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 as cid", "2 as n"), k, (num, den))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute.similar_groups(odd, k, num, den)


def test_ngram_join_of_a_large_group_of_near_copies(spark):
    base = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join(base + [f"x{i}"])) for i in range(400)] + [(1000 + i, " ".join(base)) for i in range(300)]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 700


def test_ngram_join_empty(spark):
    assert ngram_join.similar_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(1)
    for _ in range(30):
        q = np.unique(rng.integers(0, 60, 30)).astype(np.uint64)
        sets = [np.unique(rng.integers(0, 60, int(rng.integers(1, 40)))).astype(np.uint64) for _ in range(25)]
        need = [int(rng.integers(1, 20)) for _ in sets]
        assert sorted(ngram_join.divide_skip(q, sets, need)) == [i for i, s in enumerate(sets) if len(np.intersect1d(q, s)) >= need[i]]


def test_line_dedup_equals_brute_force(spark, rows):
    got = {r["d"]: (r["n_lines"], r["kept"]) for r in line_dedup.kept_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute.kept_lines(rows)


def test_line_dedup_texts_nulls_repeats_and_clashes(spark):
    rows = [(1, "a b c d e\n\nf g", 9), (2, "E d c b a\nnew line here", 9), (2, "E d c b a\nnew line here", 9), (None, "f g\nlast", 9), (3, None, 9), (4, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_kept int")
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_kept"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        (1, "a b c d e\n\nf g", 3, 3), (2, "new line here", 2, 1), (2, "new line here", 2, 1), (None, "last", 2, 1), (3, None, 1, 1), (4, "", 1, 1)]))
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_plan_has_no_python(spark, rows):
    plan = line_dedup.kept_lines(spark.createDataFrame(rows[:20], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_passages_find_every_long_exact_repeat(spark, rows):
    got = passage_chain.shared_passages(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 as pos", "0 as x"))
    spans = {}
    for r in got.collect():
        assert r["source_doc_id"] < r["doc_id"] and r["matches"] >= 0.8 * (r["end"] - r["start"])
        spans.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    first, need = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = brute.spaced(t)
        for i in range(len(w) - 50):
            z = tuple(w[i:i + 51])
            if first.setdefault(z, d) != d:
                need.setdefault(d, []).append(i)
    assert need and set(need) <= set(spans)
    clean = {d for d, t in rows if d < 120} - {d for d, _ in rows if d < 40}
    assert not clean & set(spans) - set(need)


def test_passages_without_keys_and_empty(spark):
    rng = np.random.default_rng(3)
    p = brute.words(rng, 80)
    df = spark.createDataFrame([(None, p + " tail"), (5, "head " + p), (5, "head " + p), (6, None), (7, "")], SCHEMA)
    got = passage_chain.shared_passages(df).collect()
    assert len(got) == 1 and 5 in (got[0]["doc_id"], got[0]["source_doc_id"]) and got[0]["matches"] == 80
    assert passage_chain.shared_passages(df.limit(0)).count() == 0


def test_chains_and_alignment():
    assert passage_chain.chains([0, 10, 20, 30], [100, 110, 120, 131]) == [[0, 1, 2, 3]]
    assert passage_chain.chains([0, 10, 20], [120, 110, 100]) == []  # they cross
    a = np.arange(100, dtype=np.uint64)
    b = a.copy()
    b[50] = 999
    assert passage_chain.align(a, b, np.array([20, 40, 60]), np.array([20, 40, 60])) == [(0, 100, 0, 100, 99)]
    b[30:70] = np.arange(1000, 1040)  # two passages with a foreign stretch between
    assert passage_chain.align(a, b, np.array([5, 20, 75, 90]), np.array([5, 20, 75, 90])) == [(0, 30, 0, 30, 30), (70, 100, 70, 100, 30)]


def test_chains_of_far_apart_passages():
    first, second, third = range(0, 900, 10), range(1100, 1140, 10), range(1400, 1450, 10)  # the first scores far above a gap's cost
    x = [*first, *second, *third]
    assert passage_chain.chains(x, x) == [list(range(90)), list(range(94, 99)), list(range(90, 94))]
    y = [*first, *[v - 190 for v in second], *[v + 5000 for v in third]]  # far apart in one text only
    assert passage_chain.chains(x, y) == [list(range(90)), list(range(94, 99)), list(range(90, 94))]


@pytest.mark.parametrize("sizes", [(300, 100), (300, 45, 100), (100, 60, 60)])
def test_passages_far_apart_in_a_pair(spark, sizes):
    rng = np.random.default_rng(11)
    shared = [brute.words(rng, n, 10**6) for n in sizes]
    one, two = (" ".join(w for p in shared for w in (brute.words(rng, 200, 10**6), p)) for _ in range(2))
    got = passage_chain.shared_passages(spark.createDataFrame([(1, one), (2, two)], SCHEMA)).collect()
    assert sorted(r["matches"] for r in got) == sorted(n for n in sizes if n >= 50)


def test_passage_with_loosely_similar_text_beside_it(spark):
    rng = np.random.default_rng(13)
    new = lambda n: brute.words(rng, n, 10**9)
    plain, loose = new(60), [new(12) for _ in range(6)]
    docs = [" ".join([new(30), plain, *(w for p in loose for w in (new(8), p)), new(30)]) for _ in range(2)]
    mirror = [" ".join(reversed(t.split(" "))) for t in docs]
    half = new(600).split(" ")  # verbatim for 300 words, every second word rewritten from there on
    copy = [w if i < 300 or i % 30 < 15 else f"other{i}" for i, w in enumerate(half)]
    joined = new(45), new(45)  # together a passage, apart too short
    pair = [" ".join([new(20), joined[0], new(9), joined[1], new(20)]) for _ in range(2)]
    texts = [*docs, *mirror, " ".join(half), " ".join(copy), *pair]
    got = passage_chain.shared_passages(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    spans = {(r["doc_id"], r["source_doc_id"]): (r["start"], r["end"], r["matches"]) for r in got}
    assert all(r["matches"] >= 0.8 * max(r["end"] - r["start"], r["source_end"] - r["source_start"]) for r in got)
    assert spans[1, 0][0] == 30 and spans[1, 0][1] >= 90
    assert spans[3, 2][0] <= len(texts[3].split(" ")) - 90 and spans[3, 2][1] == len(texts[3].split(" ")) - 30
    assert spans[5, 4][0] == 0 and spans[5, 4][1] >= 300
    assert spans[7, 6] == (20, 119, 90)


def test_words_said_on_and_on_are_few_passages(spark):
    rng = np.random.default_rng(29)
    said = "on and " * 300
    one, two = (" ".join([brute.words(rng, 40, 10**6), said, brute.words(rng, 40, 10**6)]) for _ in range(2))
    got = passage_chain.shared_passages(spark.createDataFrame([(1, one), (2, two)], SCHEMA)).collect()
    assert {w for r in got for w in range(r["start"], r["end"])} >= set(range(40, 640))
    assert len(got) <= 2 * 600 // passage_chain.MIN_WORDS  # one a period before


def test_covering_keeps_every_word():
    rng = np.random.default_rng(31)
    for _ in range(200):
        begin = rng.integers(0, 60, rng.integers(1, 14)).tolist()
        found = [(a, a + int(rng.integers(1, 20)), int(rng.integers(9)), 0, 0) for a in begin]
        got = passage_chain.covering(found)
        held = {w for f in found for w in range(f[0], f[1])}
        assert set(got) <= set(found) and held == {w for f in got for w in range(f[0], f[1])}
        assert all(held != {w for f in got if f != g for w in range(f[0], f[1])} for g in got)


def test_short_chains_at_the_least_similarity(spark):
    """Two runs of four words, and then only runs of three: all of 50 words at 0.8, and one word less."""
    rng = np.random.default_rng(37)
    rows, need = [], set()
    for n, (step, bad) in enumerate([(s, b) for s in range(1, 17) for b in (0, 1)]):
        p = brute.words(rng, 50, 10**9).split(" ")
        free = [i for i in range(50) if not 20 <= i < 24 + step]
        other = set(rng.choice(free, 10 + bad, replace=False).tolist())
        q = [f"new{n}x{i}" if i in other else w for i, w in enumerate(p)]
        for d, t in ((n, p), (1000 + n, q)):
            rows.append((d, " ".join([brute.words(rng, 30, 10**9), *t, brute.words(rng, 30, 10**9)])))
        ends = [i for i in range(50) if i not in other]
        if not bad and ends[0] == 0 and ends[-1] == 49:
            need.add(1000 + n)
    got = {r["doc_id"] for r in passage_chain.shared_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert need <= got and all(d % 2 == 0 for d in got)


def test_similar_parts_equal_brute_force():
    rng = np.random.default_rng(17)
    for _ in range(60):
        at_a = np.flatnonzero(rng.random(90) < rng.choice([0.75, 0.8, 0.9]))
        at_b = np.cumsum(1 + (rng.random(len(at_a)) < 0.15) * rng.integers(1, 4, len(at_a)))
        ok = [min(at_a[v] - at_a[u], at_b[v] - at_b[u]) + 1 for u in range(len(at_a)) for v in range(u, len(at_a))
              if 5 * (v - u + 1) >= 4 * (max(at_a[v] - at_a[u], at_b[v] - at_b[u]) + 1)]
        got = passage_chain.similar_parts(at_a, at_b, 20)
        assert max((min(a1 - a0, b1 - b0) for a0, a1, b0, b1, _ in got), default=0) == (max(ok) if max(ok) >= 20 else 0)
        assert all(5 * m >= 4 * max(a1 - a0, b1 - b0) for a0, a1, b0, b1, m in got)


def test_packed_numbers():
    for v in ([], [0], [5, 5, 70000, 70000 + 0xFFFF, 3_000_000], list(range(0, 4 << 20, 65535))):
        assert passage_chain.unpack(passage_chain.pack(np.array(v, np.uint64))).tolist() == v


def test_fuzzy_passages_of_sixty_words(spark):
    """Recall of passages with words replaced at random and at regular distances."""
    rng = np.random.default_rng(19)
    rows, kinds = [], {}
    for n in range(240):
        p = brute.words(rng, 60, 10**6).split(" ")
        bad = rng.choice(60, [12, 9, 6][n % 3], replace=False) if n < 180 else range(4, 60, 5)  # 0.8 to 0.9; every fifth word
        q = [f"new{n}x{i}" if i in bad else w for i, w in enumerate(p)]
        kinds[1000 + n] = ("0.80", "0.85", "0.90")[n % 3] if n < 180 else "regular"
        for d, t in ((n, p), (1000 + n, q)):
            rows.append((d, " ".join([brute.words(rng, 40, 10**6), *t, brute.words(rng, 40, 10**6)])))
    got = {r["doc_id"] for r in passage_chain.shared_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    recall = {k: sum(d in got for d in kinds if kinds[d] == k) / sum(v == k for v in kinds.values()) for k in set(kinds.values())}
    print(recall)
    assert min(recall.values()) >= 0.95


def test_passage_whose_pieces_stood_earlier_elsewhere(spark):
    rng = np.random.default_rng(23)
    new = lambda n: brute.words(rng, n, 10**6)
    p = new(60).split(" ")
    pieces = [p[:35], p[25:], p[15:45]]  # no document before the whole one has 50 words of it
    texts = [" ".join([new(20), *w, new(20)]) for w in (*pieces, p, p)]
    got = passage_chain.shared_passages(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert [(r["doc_id"], r["source_doc_id"], r["start"], r["end"], r["matches"]) for r in got] == [(4, 3, 20, 80, 60)]


def test_runs_of_shared_kmers():
    g, text = np.arange(12, dtype=np.uint64), np.repeat([0, 1], 6)
    g[6:] = g[:6]
    ok = np.ones(12, bool)
    ok[1] = False
    v, i = passage_chain.runs(g, ok, text, 4)
    assert sorted(i.tolist()) == [2, 6, 7, 8] and len(np.unique(v)) == 3
    assert len(passage_chain.runs(np.zeros(50, np.uint64), np.ones(50, bool), np.zeros(50, int), 10)[0]) == 1


def test_seeds_of_short_and_repetitive_texts():
    for n in range(0, 40):
        h, first = passage_chain.word_hashes(__import__("pyarrow").array([" ".join(f"w{i}" for i in range(n)), "a " * n, None]))
        g, at = passage_chain.seeds(h, first)
        assert len(g) == len(at) and (n < passage_chain.K or len(g) >= 2)


@pytest.fixture(scope="module")
def items(rows):
    return [(1, rows[0][1]), (2, " ".join(brute.alnum(rows[130][1])[:25])), (11, "short item"), (12, ""), (13, None), (2, "w1 w2 w3"), (None, rows[5][1])]


def test_fm_index_equals_brute_force(spark, rows, items):
    docs = spark.createDataFrame([*rows, (900, "x Short, ITEM y " + rows[0][1] + " short item"), (901, "short"), (902, "item short")], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.decontaminate([tuple(r) for r in docs.collect()], [("null" if i is None else i, t) for i, t in items])
    for block_bytes in (fm_index.BLOCK_BYTES, 200):  # one block, and several
        got = fm_index.decontaminate(docs.selectExpr("*", "7 as items"), bench, block_bytes=block_bytes).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), fm_index.items_digest(r["items"])) for r in got} == want
        for r in got:
            assert (r["clean_text"] == r["text"]) == (r["n_hit"] == 0)
            assert len(brute.alnum(r["clean_text"])) == r["n_words"] - r["n_hit"]
    assert fm_index.decontaminate(docs.limit(0), bench).count() == 0
    assert {r["n_hit"] for r in fm_index.decontaminate(docs, bench.limit(0)).collect()} == {0}


def test_fm_index_ranges_and_positions():
    rng = np.random.default_rng(5)
    sym = rng.integers(0, 5, 3000)
    sym[-1] = 0
    index = fm_index.FMIndex(sym, 5)
    for m in (1, 2, 4):
        rows = np.unique(rng.integers(1, 5, (30, m)), axis=0)
        lo, hi = index.ranges(rows)
        for p, i, j in zip(rows, lo, hi, strict=True):
            want = [k for k in range(len(sym) - m + 1) if (sym[k:k + m] == p).all()]
            assert sorted(index.locate(np.arange(i, j)).tolist()) == want


def test_word_splitting_matches_the_patterns():
    import pyarrow as pa
    texts = ["Hello, wörld! 12a_b", "", None, "\x00x\x7fy", "ÀÉ A B", " lead", "tail "]
    for separators, plain in ((W.NON_ALNUM, brute.alnum), (W.SPACE, brute.spaced)):
        data, off = W.buffers(pa.array(texts))
        cls = W.WordClass(separators)
        s, e, first = W.split_words(data, off, cls)
        low = cls.low[data].tobytes()
        got = [[low[s[k]:e[k]].decode() for k in range(first[i], first[i + 1])] for i in range(len(texts))]
        assert got == [plain(t) for t in texts]
