"""Personal data: base patterns against Python's, bootstrapping against a plain version."""

import hashlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm import brute

from pixtrend.llm import pii_bootstrap, queries


def run(spark, folder, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return queries.QUERIES["op13_pii_bootstrap"](spark, str(folder)).collect()


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(got, rows):
    want = []
    for (d, t, *_), spans in zip(rows, brute.pii_spans([r[1] for r in rows]), strict=True):
        base = brute.pii_base(t)
        want.append((d, *[sum(k == kind for k, _, _ in base) for kind in brute.PII], hashlib.sha256(digest(base).encode()).hexdigest(), digest(spans)))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"])) for r in got)


def card(rng):
    head = "".join(str(int(d)) for d in rng.integers(0, 10, 15))
    return head + next(c for c in "0123456789" if brute.luhn(head + c))


def corpus(n=400, seed=5):
    """Labelled data, most of it in the base form, some in forms only the context tells."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        area, line = rng.integers(200, 999), rng.integers(1000, 9999)
        said = [f"please call me at +1 ({area}) 555-{line} today", f"reach me under +1 {area} 555 {line} or", f"pay by card {card(rng)} now",
                f"the server address {rng.integers(1, 250)}.{rng.integers(1, 250)}.7.9 was", f"write to user.{i}@mail{i % 7}.example.com soon", f"in room {line} of block {area}"][i % 6]
        odd = [f"please call me at ({area}) 555-{line} today", f"reach me under {area} 555 {line} or", f"pay by card {int(card(rng)) // 10}7 now",
               f"the server address fe80::{area}:{line} was", f"write to admin{i}@localhost soon", "nothing here"][i % 6]
        rows.append((i, f"{brute.words(rng, 5)} {odd if i % 13 == 0 else said} {brute.words(rng, 4)}"))
    return rows


def test_query_equals_the_plain_version_and_finds_unseen_forms(spark, tmp_path):
    rows = corpus()
    got = run(spark, tmp_path, rows)
    check(got, rows)
    new = {r["doc_id"] for r in got if len([s for s in r["spans"].split(",") if s]) > r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]}
    planted = {i for i, _ in rows if i % 13 == 0 and i % 6 != 5}
    assert len(new & planted) > 0.9 * len(planted) and not new - planted


def test_second_round_finds_what_the_first_made_known(spark, tmp_path):
    rows = [(i, f"dial home {f'+1 415 555 {1000 + i}' if i % 2 else f'(415) 555-{1000 + i}'} please") for i in range(30)]
    rows += [(100 + i, f"other ways (415) 555-{1000 + i} again") for i in range(0, 30, 2)] + [(200, "other ways (415) 555-9999 again")]
    got = run(spark, tmp_path, rows)
    check(got, rows)
    assert next(r for r in got if r["doc_id"] == 200)["spans"].startswith("phone:")


def test_edges(spark, tmp_path):
    long = "a" * 20_000 + "@b.c " + "1" * 15_000 + " " + "1.1" * 5_000 + " +1" + "(" * 20_000 + " a@b.c_x@d.e.f 4111-1111 1111 1111"
    texts = [None, "", "@", "+", "x@y", "a@b.c", "A.b%c+d@e-f.g.h..i", "1.2.3.4.5.6.7.8", "0001.2.3.255", "1.2.3.256", "4111111111111111", "41111111111111112",
             "+1 (017) 555-7713", "+12345678", "++1234567890", "é\U0001F600 a@b.cd \U0001F600 +44 20 7946 0958", "a@b.c@d.e", "tel:+1-017-555-7713, 10.0.0.1.", "٣٤ 12", long, "%" * 30_000 + "9" + "!" * 30_000]
    rows = [(i if i % 4 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(5, "a@b.c", "clash", 1)] * 2
    check(run(spark, tmp_path, rows, "doc_id long, text string, row string, hits int"), rows)


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab.@-+()0159 \n%_:é", max_size=40), min_size=40, max_size=60))
def test_base_patterns_on_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = pii_bootstrap._spans(df.select(df.doc_id.alias("row"), pii_bootstrap._hits(df.text).alias("hits"))).where("kind <> 'chunk'").collect()
    want = {(i, *s) for i, t in enumerate(texts) for s in brute.pii_base(t)}
    assert {(r["row"], r["kind"], r["start"], r["end"]) for r in spans} == want


def test_no_python_on_the_main_path(spark, tmp_path):
    spark.createDataFrame(corpus(60), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.QUERIES["op13_pii_bootstrap"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("digits,ok", [("4111111111111111", True), ("4111111111111112", False), ("79927398713", True)])
def test_luhn(spark, digits, ok):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii_bootstrap.luhn(F.lit(digits)).alias("ok")).first()["ok"] is ok
