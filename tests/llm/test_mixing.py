import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import mixing


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 else f"s{i % 4}"
        rows.append((i, "word " * (1 + i % 20), ["en", "de", None][i % 7 % 3], source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def shares(cells, side):
    rows = cells.groupBy(side).agg(F.sum("weight").alias("w")).collect()
    total = sum(r["w"] for r in rows)
    return {r[side]: r["w"] / total for r in rows}


def test_marginals_are_met(corpus):
    targets = {"source": {"hot": 0.5, "s0": 0.2, "s1": 0.1, "s2": 0.1, "s3": 0.1}}
    cells = mixing.raked(mixing.described(corpus), targets, share=0.2)
    got = shares(cells, "source")
    assert all(abs(got[k] - v) < 0.01 for k, v in targets["source"].items())
    assert cells.where("probability < 0 or probability > 1").count() == 0
    total = corpus.select(F.sum(mixing.tokens_of(F.col("text")))).first()[0]
    assert abs(cells.agg(F.sum("weight")).first()[0] - 0.2 * total) < 0.01 * total


def test_against_plain_fitting(corpus):
    cells = mixing.described(corpus).groupBy(*mixing.SIDES).agg(F.sum("n_tokens").alias("t")).collect()
    state = {tuple(r[s] for s in mixing.SIDES): 0.5 * r["t"] for r in cells}
    has = {tuple(r[s] for s in mixing.SIDES): r["t"] for r in cells}
    total = sum(state.values())
    wish = []
    for n in range(3):
        sums = {}
        for k, v in has.items():
            sums[k[n]] = sums.get(k[n], 0) + v
        powers = {k: v**mixing.TEMPER for k, v in sums.items()}
        wish.append({k: v / sum(powers.values()) * total for k, v in powers.items()})
    for _ in range(mixing.SWEEPS):
        for n in range(3):
            now = {}
            for k, v in state.items():
                now[k[n]] = now.get(k[n], 0) + v
            state = {k: v * wish[n][k[n]] / now[k[n]] for k, v in state.items()}
        state = {k: min(v, has[k]) for k, v in state.items()}
    got = {tuple(r[s] for s in mixing.SIDES): r["weight"] for r in mixing.raked(mixing.described(corpus)).collect()}
    assert got.keys() == state.keys()
    assert all(abs(got[k] - state[k]) < 1e-6 * total for k in got)


def test_draws_follow_the_probabilities_and_repeat(corpus):
    first = mixing.sampled(corpus)
    rows = first.agg(F.sum("probability"), F.sum(F.col("sampled").cast("int")), F.count("*")).first()
    assert rows[2] == 3000 and abs(rows[0] - rows[1]) < 120
    again = mixing.sampled(corpus.repartition(7))
    assert first.where("sampled").select("doc_id").exceptAll(again.where("sampled").select("doc_id")).count() == 0


def test_shuffled_lookup_gives_the_same(corpus, monkeypatch):
    first = mixing.sampled(corpus).select("doc_id", "sampled")
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    assert first.exceptAll(mixing.sampled(corpus).select("doc_id", "sampled")).count() == 0


def test_values_without_target_get_nothing(corpus):
    got = mixing.sampled(corpus, {"source": {"hot": 1.0}})
    assert {r["source"] for r in got.where("sampled and n_tokens > 0").select("source").distinct().collect()} == {"hot"}


def test_odd_rows(odd):
    got = mixing.sampled(odd)
    assert got.count() == odd.count()
    assert got.where("n_tokens = 0").count() == 3
    assert got.where("probability is null or sampled is null").count() == 0
    assert [c.lower() for c in got.columns].count("n_tokens") == 1
    assert mixing.sampled(odd.limit(0)).count() == 0


def test_topics(documents):
    df = mixing.described(documents("MIT license", "a@b or", "WOW!! yes", "x = {1}", "plain", None))
    assert [r["topic"] for r in df.orderBy("doc_id").collect()] == [
        "legal", "contact", "emphatic", "technical", "general", "general",
    ]
