import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, every, k):
    usable = [
        (i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int))
        for i, v, *_ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % every:
            continue
        scored = sorted((-int(np.dot(a, b)), i) for i, b in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def answers(spark, rows, every=5, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % every == 0, **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("block", [8192, 60])
def test_against_brute_force(spark, block):
    random = np.random.default_rng(block)
    rows = [(i, (random.standard_normal(12) * 0.2).tolist(), 0) for i in range(400)]
    assert answers(spark, rows, block=block, query_block=30) == brute_force(rows, 5, 5)


def test_ties_and_copies_go_to_the_smaller_id(spark):
    rows = [(i, [0.5, -0.25], 0) for i in range(40)] + [(100, [0.0, 0.0], 0)]
    assert answers(spark, rows) == brute_force(rows, 5, 5)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1),
        (5, [1.0, -inf], 1), (None, [9.0, 9.0], 1), (6, [-1.0, 0.001], None), (7, [0.1, 0.2], 1),
    ]
    assert answers(spark, rows) == brute_force(rows, 5, 5)


def test_repeated_rows_and_short_vectors(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1)]
    # rows of the query's id are its own; another id's rows each count
    assert answers(spark, rows) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
    df = spark.createDataFrame([(0, [1.0, 1.0], 1), (1, [1.0], 1)], SCHEMA)
    got = topk.top_k(df, F.col("vec_id") == 0).first()
    assert got["score"] == 65536


def test_huge_components_score_exactly(spark):
    """Components of a million: scores near 2**60, and vectors that differ in a last place."""
    big = [0.5e6 + 1 / 256, -1e6, 1e6, 1.0]
    rows = [(0, big, 0), (1, [x + 1 / 4 for x in big], 0), (2, big, 0), (3, [-x for x in big], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = topk.top_k(df, F.col("vec_id") == 0).collect()
    whole = [np.floor(256 * np.array(v)).astype(int).tolist() for _, v, _ in rows]
    scores = {i: sum(x * y for x, y in zip(whole[0], whole[i])) for i in (1, 2, 3)}
    expected = sorted(scores.items(), key=lambda s: (-s[1], s[0]))
    assert [(r["vec_id"], r["score"]) for r in got] == expected


def test_scores_beyond_64_bits_fail(spark):
    with pytest.raises(Exception, match="64 bits"):
        answers(spark, [(0, [3e38, 1.0], 0), (1, [1.0, -1.0], 0)])


def test_clashing_names(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = topk.top_k(df, F.col("vec_id") % 5 == 0).collect()
    named = df.withColumns({"block": F.lit(1), "vector": F.lit("v"), "QUERY": F.lit(2), "rank": F.lit(3)})
    assert topk.top_k(named, F.col("vec_id") % 5 == 0).collect() == plain


def test_nothing_to_search(spark):
    assert answers(spark, []) == []
    assert answers(spark, [(0, [1.0], 0)]) == []
    assert answers(spark, [(1, [1.0], 0), (2, [1.0], 0)]) == []


def test_levels_fall_and_bounds_hold():
    random = np.random.default_rng(0)
    vectors = random.integers(-100, 100, (200, 8))
    index = topk.Index(vectors)
    impacts = [np.abs(s).max() for s, _ in index.segments]
    assert impacts == sorted(impacts, reverse=True)
    so_far = np.zeros_like(vectors, dtype=float)
    for segment, rest in index.segments:
        so_far += segment
        assert np.allclose(rest, np.sqrt(((vectors - so_far) ** 2).sum(axis=1)))


def test_queries_are_not_broadcast(spark, monkeypatch):
    """Copies of the queries for all blocks stay off the driver, however small one copy is."""
    plans, stored = [], topk.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(topk, "stored", seen)
    random = np.random.default_rng(1)
    rows = [(i, (random.standard_normal(6) * 0.2).tolist(), 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, block=20, query_block=7)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert not [plan for plan in plans if "Broadcast" in plan or "Join" in plan]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == brute_force(rows, 5, 5)
