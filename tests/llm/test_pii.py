import re

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def brute_force(text):
    kinds = list(BASE)
    found = [
        (m.start(), kinds.index(k), m.end())
        for k, p in BASE.items()
        for m in re.finditer(p, text)
        if holds(k, m[0])
    ]
    return [(s, e, kinds[k]) for s, k, e in sorted(found)]


TEXTS = [
    "mail a@b.co_x@y.zz or x.y+z@a-b.c.d, a@b@c.com and @@a.b",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.00.1.1 and 1.2..3.4.5.6",
    "card 4111 1111 1111 1111 and 4111111111111112 and 12345678901234567890123",
    "call +1 (988) 555-2485 or +49-30-1234567890123 or +1 2",
    "é\U0001f600 a@b.co \U0001f600 +441234567890",
    "4532015112830366.1.2.3 +4532015112830366",
    "x" * 30000 + "@b.co " + "1." * 20000 + " " + "+1+1" * 5000,
    "a@b" + ".c" * 20000,
]


@pytest.fixture(scope="module")
def model():
    return pii.learn({})


def test_base_spans_against_brute_force(documents, model):
    rows = pii.find_personal_data(documents(*TEXTS), model).collect()
    for row in rows:
        base = [(s["start"], s["end"], s["kind"]) for s in row["spans"] if s["base"]]
        assert base == brute_force(row["text"]), row["text"][:60]


def test_secrets_are_learnt_and_added(documents):
    key = "0641917ea4e9feb9cda83477b57ac2654884f4"
    df = documents(*[f'api token = "{key}{i:02x}" end' for i in range(40)], "nothing", "a@b.co")
    rows = pii.find_personal_data(df).collect()
    secrets = [s for r in rows for s in r["spans"] if s["kind"] == "secret"]
    assert len(secrets) == 40 and not any(s["base"] for s in secrets)
    assert {(s["start"], s["end"]) for s in secrets} == {(13, 53)}


def test_reliabilities_follow_the_votes():
    # a labeler that agrees with the others is trusted more than one that does not
    counts = {("email", "+++031"): 80, ("email", "---031"): 80, ("email", "+++-31"): 20, ("email", "---+31"): 20}
    model = pii.learn(counts)
    assert model.reliability["email", "strict"]["+"] > model.reliability["email", "context"]["+"]


def test_redaction(documents, model):
    df = documents("to a@b.co, +1 (988) 555-2485 x", None, "", "4532015112830366.1.2.3")
    got = [r["text"] for r in pii.redact(df, model).orderBy("doc_id").collect()]
    assert got[:3] == ["to [EMAIL], [PHONE] x", None, ""]
    # overlapping spans are replaced once
    assert got[3].count("[") == 1


def test_odd_rows(odd):
    got = pii.find_personal_data(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and all(r["spans"] == [] for r in rows)
    assert pii.find_personal_data(odd.limit(0)).count() == 0
    clash = odd.withColumn("SPANS", F.lit(1))
    assert [c.lower() for c in pii.find_personal_data(clash).columns].count("spans") == 1


def test_no_python_in_the_plan(odd, model):
    text = pii.find_personal_data(odd, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in pii.op3_pii(spark, folder).collect():
        expected = brute_force(docs[row["doc_id"]] or "")
        listed = [f"{k}:{s}:{e}" for s, e, k in expected]
        assert set(listed) <= set(row["spans"].split(",")) | {""}
        for kind in BASE:
            assert row[f"n_{kind}"] == sum(k == kind for _, _, k in expected)
