"""Base spans against the patterns as they are stated, added spans on planted cases, and edge cases."""

import hashlib
import random
import re
import time

import pytest

from sitefold.llm import personal_data as P


def luhn(digits):
    return sum((v * 2 - 9 * (v > 4)) if k % 2 else v for k, v in enumerate(map(int, reversed(digits)))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
)


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m[0])]


@pytest.fixture(scope="module")
def model(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def found(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    return {r.doc_id: r for r in P.digest(P.detect(docs, model)).collect()}


def same(texts, got):
    for k, text in enumerate(texts):
        b = base(text)
        assert got[k].base_sha256 == hashlib.sha256(",".join(b).encode()).hexdigest(), text[:200]
        assert set(b) <= set(got[k].spans.split(","))
        assert [got[k][f"n_{x}"] for x, _, _ in PLAIN] == [sum(s.startswith(f"{x}:") for s in b) for x, _, _ in PLAIN]


def test_base_spans_of_random_texts(spark, model):
    rng = random.Random(3)
    alphabet = "a.@+1 2-(9)_:é\U0001f600bDE4[]\x01"
    same(texts := ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80))) for _ in range(3000)], found(spark, model, texts))


def test_base_spans_of_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    same(texts, found(spark, model, texts))


def test_odd_texts(spark, model):
    texts = [None, "", "\x01a@b.co\x01", "a@b.com_x@y.org a@b.c@d.e.f", "a@" + "b." * 500, "1.2.3." * 200, "+1" + "(" * 500, "+" * 500]
    got = found(spark, model, texts)
    same(texts, got)
    assert got[0].spans == got[1].spans == ""


def test_long_texts_take_time_in_proportion(spark, model):
    n = 20_000
    texts = ["1" * 200_000, "a" * 1_000_000 + "@", "a@" + "b." * 200_000, "x@y.z " * n, "12 " * n, "+" * 200_000, "+1" + "(" * 200_000, "1.2.3." * n]
    start = time.time()
    got = found(spark, model, texts)
    assert time.time() - start < 60
    assert [(got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone) for k in range(8)] == [(0,) * 4, (0,) * 4, (1, 0, 0, 0), (n, 0, 0, 0), (0,) * 4, (0,) * 4, (0,) * 4, (0, n // 4 * 3, 0, 0)]
    assert got[2].spans == f"email:0:{2 + 399_999}"
    assert got[3].spans.endswith(f"email:{6 * n - 6}:{6 * n - 1}")


PERSONAL = (
    "+1 (487) 555-7209 4736962573099581",  # each in the other's way
    "so call 0171 555 7713 today",
    "phone 212-555-0187 if late",
    "Her SSN is 123-45-6789, keep it",
    "pay to IBAN DE89 3704 0044 0532 0130 00 please",
    "amex 378282246310005 was charged",
    "write to jane.roe at example dot org",
)
CLEAN = (
    "In 1990 1995 2000 2005 the figures rose.",
    "Version 10.4.2 of 2024-01-15 and order 0171 555 7713.",
    "ISBN 978-3-16-148410-0 is a book",
    "the ratio was 3:4:5 at 12:30:45 and 1,000,000.50 paid",
    "numbers like 4736962573099582 fail their check sum",
    "Plain prose without a single digit, at least not one dot.",
)


def test_added_spans(spark, model):
    got = found(spark, model, PERSONAL + CLEAN)
    for k, text in enumerate(PERSONAL):
        assert got[k].spans, text
    assert got[0].spans == "card:18:34,phone:0:17"
    for k, text in enumerate(CLEAN, len(PERSONAL)):
        assert got[k].spans == "", text


def test_added_spans_do_not_overlap(spark, model):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(PERSONAL) for _ in range(4)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in P.detect(docs, model).collect():
        taken = sorted((s.start, s.end) for s in r.added)
        assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:]))
        assert not any(s.start < b.end and b.start < s.end for s in r.added for b in r.base)


def test_redaction_keeps_columns(spark, model):
    docs = spark.createDataFrame([(1, "mail a@b.co now", "x"), (None, None, "y"), (1, "", "z"), (2, "a@b.c 4.4.4.4", "w")], "doc_id bigint, text string, _spans string")
    out = P.redact(docs, model)
    assert out.columns == docs.columns
    assert {r._spans: r.text for r in out.collect()} == {"x": "mail [EMAIL] now", "y": None, "z": "", "w": "[EMAIL] [IP]"}


def test_empty_table_and_seeds_alone(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    m = P.fit(none)
    assert P.digest(P.detect(none, m)).count() == 0
    assert found(spark, m, ["my phone is +1 (487) 555-7209"])[0].spans == "phone:12:29"


def test_native(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = P.digest(P.detect(docs, model))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_calibration():
    assert P._threshold([(0.9, 1.0, 1.0), (0.8, 1.0, 1.0), (0.2, 0.0, 1.0)]) == 0.8
    assert P._threshold([(0.9, 0.0, 1.0), (0.8, 1.0, 1.0)]) == 2.0
    assert P._threshold([]) == 2.0
