import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import toxicity
from tests.llm.conftest import LONG

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.learn(*tables)


def test_held_out_rows_are_judged_well(tables, model):
    docs, labels = tables
    known = labels.where("toxic IS NOT NULL").select("doc_id", "toxic")
    scored = toxicity.score(docs, model).where(toxicity.held_out()).join(known, "doc_id")
    rows = scored.select("score", "predicted", "toxic").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in rows)
    precision = hits / sum(r["predicted"] for r in rows)
    recall = hits / sum(r["toxic"] for r in rows)
    assert precision > 0.8 and recall > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_odd_rows(odd, model):
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r["score"] for r in rows}
    # without words there is no evidence
    assert by_id[0] == by_id[1] == by_id[2]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert any(r["text"] == LONG for r in rows)
    assert toxicity.score(odd.limit(0), model).count() == 0
    clash = odd.withColumn("SCORE", F.lit("x"))
    assert [c.lower() for c in toxicity.score(clash, model).columns].count("score") == 1


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} {'bad' if i % 5 == 0 else 'good'}") for i in range(300)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = toxicity.learn(docs, labels), toxicity.learn(docs, other)
    assert np.array_equal(first.differences, second.differences) and first.weights == second.weights


def test_no_or_strange_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd, none)
    assert len({r["score"] for r in toxicity.score(odd, model).collect()}) == 1
    strange = spark.createDataFrame([(3, 1, None), (None, 1, 1), (4, 0, 0), (4, 0, 1), (99, 1, 1)],
                                    "doc_id long, quality int, toxic int")
    assert toxicity.score(odd, toxicity.learn(odd, strange)).count() == odd.count()
    assert toxicity.score(odd, toxicity.learn(odd.limit(0), none)).count() == odd.count()


def test_likelihoods_against_plain_kneser_ney(spark):
    """Counts of words by kind, smoothed by hand."""
    words = {"idiot": (6, 0, 4, 0, 0), "ideal": (9, 5, 1, 0, 0), "a": (20, 11, 6, 1, 2), "zz": (1, 0, 0, 0, 0)}
    df = spark.createDataFrame([(w, *c) for w, c in words.items()], "word string, n long, n1 long, n2 long, n3 long, n4 long")
    got = {r["gram"]: r for r in toxicity._smoothed(toxicity._spelt(df)).collect()}
    n, d = toxicity.ORDER, toxicity.DISCOUNT
    grams = defaultdict(lambda: [0] * 5)
    for word, counts in words.items():
        padded = toxicity._START * (n - 1) + word + toxicity._END
        for i in range(len(word) + 1):
            for k in range(5):
                grams[padded[i : i + n]][k] += counts[k]
    kinds = {n: set(grams)}
    continuation = {}
    for order in range(n - 1, 0, -1):
        continuation[order] = Counter(g[1:] for g in kinds[order + 1])
        kinds[order] = set(continuation[order])

    def shared(gram):
        if not gram:
            return 1 / 256
        level = continuation[len(gram)]
        beside = [g for g in level if g[:-1] == gram[:-1]]
        total = sum(level[g] for g in beside)
        return (max(level[gram] - d, 0) + d * len(beside) * shared(gram[1:])) / total

    def likelihood(gram, count):
        beside = [g for g in grams if g[:-1] == gram[:-1]]
        total = sum(count(grams[g]) for g in beside)
        if not total:
            return math.log(shared(gram[1:]))
        types = sum(count(grams[g]) > 0 for g in beside)
        return math.log((max(count(grams[gram]) - d, 0) + d * types * shared(gram[1:])) / total)

    assert set(got) == set(grams)
    for gram, row in got.items():
        assert math.isclose(row["t0"], likelihood(gram, lambda c: c[2]), abs_tol=1e-9)
        assert math.isclose(row["o0"], likelihood(gram, lambda c: c[1]), abs_tol=1e-9)
        assert math.isclose(row["t1"], likelihood(gram, lambda c: c[2] + c[4]), abs_tol=1e-9)
        assert math.isclose(row["o1"], likelihood(gram, lambda c: c[1] + c[3]), abs_tol=1e-9)


def test_share_of_toxic_rows_is_kept_at_any_size(spark):
    """Some 27,000 ordinary and 3,000 toxic rows to calibrate with, whose words tell nothing."""
    docs = spark.range(0, 120_000, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 7).alias("text"))
    labels = docs.select("doc_id", (F.xxhash64("doc_id") % 10 == 0).cast("int").alias("toxic"))
    share = labels.where(toxicity._fold() == 3).agg(F.avg("toxic")).first()[0]
    scores = toxicity.score(docs, toxicity.learn(docs, labels)).where(toxicity._fold() == 3)
    assert math.isclose(scores.agg(F.avg("score")).first()[0], share, abs_tol=0.005)


def test_telling_words_are_found_beside_a_very_frequent_one():
    padded = [toxicity._START * 4 + w + toxicity._END for w in ("idiot", "moron", "stupid")]
    grams = {w[i : i + 5] for w in padded for i in range(len(w) - 4)}
    keys = np.sort(toxicity._digests(sorted(grams)))
    memory = toxicity._Memory(keys, np.arange(1, len(keys) + 1), False)

    def describe(text):
        (words,), = toxicity._counted([text])
        memory.learn([words])
        return toxicity._describe(words, memory)

    few, many = describe("idiot moron stupid"), describe("idiot moron stupid" + " idiot moron stupid" * 100)
    assert few[2:] == many[2:] and few[3] != 0 and few[4] != 0


def test_scores_do_not_depend_on_how_many_groups_are_held(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"word{i % 7} {chr(97 + i % 26) * 3} {'bad' if i % 5 == 0 else 'good'}" if i % 9 else None) for i in range(300)],
        "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    scores = []
    for held in (1 << 20, 30):
        monkeypatch.setattr(toxicity, "HELD_GROUPS", held)
        model = toxicity.learn(docs, labels)
        assert len(model.keys) <= held and (model.rest is None) == (held > 30)
        scores.append(sorted(map(tuple, toxicity.score(docs, model, ["doc_id"]).collect())))
    assert len(scores[0]) == 300 and scores[0] == scores[1]


def test_spelling_of_many_words_at_once():
    """Sums and missing groups of words looked up together, against one group at a time."""
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcé中"), rng.integers(1, 9))) for _ in range(3000)})
    padded = {w: toxicity._START * 4 + w + toxicity._END for w in words}
    groups = {w: [p[i : i + 5] for i in range(len(w) + 1)] for w, p in padded.items()}
    every = sorted({g for found in groups.values() for g in found})
    held = [g for g in every if rng.random() < 0.8]
    order = np.argsort(toxicity._digests(held))
    values = rng.integers(-9000, 9000, len(held)).astype(np.int32)
    worth = dict(zip([held[i] for i in order], values.tolist()))
    assert len(set(toxicity._digests(every).tolist())) == len(every)
    sums, missing = toxicity._speller(toxicity._digests(held)[order], values)(words)
    assert sums == [sum(worth.get(g, 0) for g in groups[w]) for w in words]
    assert missing == {
        w: [g for g in found if g not in worth] for w, found in groups.items() if not worth.keys() >= set(found)
    }
    none = toxicity._speller(np.zeros(0, np.uint64), np.zeros(0, np.int32))(words[:2])
    assert none[0] == [0, 0] and list(none[1]) == words[:2]
    assert toxicity._speller(np.zeros(0, np.uint64), np.zeros(0, np.int32))([]) == ([], {})


def test_scores_are_made_where_the_features_are(odd, model):
    scored = toxicity.score(odd, model)
    # one pass, so one worker beside each task, and each text goes to it once
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "__in_0" not in plan
    described = toxicity._features(odd, model.keys, model.differences, model.rest, ["doc_id", "text"])
    names, w = [f.name for f in toxicity._FEATURES], np.array(model.weights)
    expected = []
    for row in described.collect():
        x = toxicity._scaled(np.array([[row[n] for n in names]]))
        expected.append((str(row["doc_id"]), row["text"], float(1 / (1 + np.exp(-(w[0] + x @ w[1:])))[0])))
    got = [(str(r["doc_id"]), r["text"], r["score"]) for r in scored.collect()]
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in expected], rel=1e-12)
