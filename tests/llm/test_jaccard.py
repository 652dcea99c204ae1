import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import jaccard
from tests.llm.conftest import LONG


def shingles_of(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute_force(rows, words, least):
    sets = [shingles_of(t, words) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= least * (len(sets[a]) + len(sets[b]) - both):
            label[find(a)] = find(b)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(
        ((rows[i][0], len(sets[i]), low[find(i)]) for i in range(len(rows))), key=str
    )


def result(spark, rows, words, least):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_groups(df, words, least)
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, groups, each, length, edits):
    """Copies with a few changed words, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(length)]
    texts = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        if g % 2:
            base = base + passage
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words))
                change = rng.random()
                if change < 0.5:
                    words[at] = rng.choice(vocabulary)
                elif change < 0.8:
                    words.insert(at, rng.choice(vocabulary))
                else:
                    del words[at]
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "least"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("most", [1024, 12])
def test_against_brute_force(spark, monkeypatch, words, least, most):
    # few sets per task: regions are divided by pivots, then dealt out in pieces
    monkeypatch.setattr(jaccard, "MOST_SETS", most)
    monkeypatch.setattr(jaccard, "STRETCH", 8)
    rows = corpus(words * most, 10, 25, 60, 4)
    assert result(spark, rows, words, least) == brute_force(rows, words, least)


@pytest.mark.parametrize(("words", "least"), [(3, 90), (5, 80), (1, 50)])
def test_short_texts_of_every_size(spark, words, least):
    rng = random.Random(least)
    rows = [
        (i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 14)))) for i in range(250)
    ]
    assert result(spark, rows, words, least) == brute_force(rows, words, least)


@pytest.mark.parametrize("least", [50, 80, 90, 95])
def test_linked_sets_share_a_named_part(least):
    rng = np.random.default_rng(least)
    for _ in range(600):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = a.copy()
        while True:
            b = b[rng.permutation(len(b))]
            b = np.append(b[1:], rng.integers(0, 1 << 62, 1).astype(np.uint64)) if rng.random() < 0.4 else b[1:]
            b = np.unique(b)
            both = len(np.intersect1d(a, b))
            if len(b) == 0 or 100 * both < least * (len(a) + len(b) - both):
                break
            common = np.sort(rng.choice(a, len(a) // 3, replace=False))
            for known in (None, common):
                of_a, of_b = (jaccard.signatures(s, least, known) for s in (a, b))
                assert np.array_equal(a, b) or len(np.intersect1d(of_a, of_b))


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    got = jaccard.overlaps(sets)
    for i, j in itertools.product(range(40), repeat=2):
        assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_a_third_of_all_texts_are_copies(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i, base) for i in range(60)] + [(60 + i, f"{base} x{i}") for i in range(60)] + [
        (200 + i, " ".join(f"u{i}v{j}" for j in range(40))) for i in range(60)
    ]
    assert result(spark, rows, 3, 90) == brute_force(rows, 3, 90)


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    rows += [(None, "one two three four"), (None, "one two three four"), (7, "A B"), (8, "a b"), (9, "a\tb"), (10, LONG + "x")]
    assert result(spark, rows, 3, 90) == brute_force(rows, 3, 90)
    assert result(spark, [], 3, 90) == []
    assert jaccard.jaccard_groups(odd.withColumnRenamed("more", "SET_ID")).count() == odd.count()


def near_copies(count, length=300, seed=4):
    """Texts that differ from one in a word or two each, and some of no group."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    texts = []
    for i in range(count):
        words = list(base)
        for _ in range(rng.randint(1, 2)):
            words[rng.randrange(length)] = f"x{i}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{i}v{rng.randrange(900)}" for _ in range(60)) for i in range(50)]
    return list(enumerate(texts))


def test_a_large_group_of_near_copies_is_compared_in_proportion(spark, monkeypatch):
    """Rows that meet in tasks grow with the group, not with its square."""
    dealt, seen = jaccard._dealt, []

    def counted(regions, sizes):
        rows = dealt(regions, sizes)
        seen.append(rows.count())
        return rows

    monkeypatch.setattr(jaccard, "_dealt", counted)
    monkeypatch.setattr(jaccard, "MOST_SETS", 64)
    monkeypatch.setattr(jaccard, "STRETCH", 64)
    made = []
    for count in (750, 3000):
        seen.clear()
        rows = near_copies(count)
        got = result(spark, rows, 3, 90)
        made.append(sum(seen))
        component = {doc: low for doc, _, low in got}
        assert all(component[i] == 0 for i in range(count))
        assert all(component[i] == i for i in range(count, count + 50))
    assert made[1] <= 6 * max(made[0], 750)
    assert made[1] <= 3 * 3000


def test_open_sets_meet_all_others(spark, monkeypatch):
    """Chains: each text is near its neighbours only, so most are far from any pivot."""
    monkeypatch.setattr(jaccard, "MOST_SETS", 8)
    monkeypatch.setattr(jaccard, "STRETCH", 8)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 80])) for i in range(150)]
    rng = random.Random(1)
    for _ in range(60):
        kept = list(words[:80])
        kept[rng.randrange(80)] = f"z{rng.randrange(40)}"
        rows.append((len(rows), " ".join(kept)))
    assert result(spark, rows, 3, 90) == brute_force(rows, 3, 90)
    assert result(spark, rows, 5, 80) == brute_force(rows, 5, 80)


def test_components(spark):
    from bazaarlens.llm.common import components

    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1120)]  # a chain
    edges += [(5000, i) for i in range(5001, 5200)] + [(7, 7), (-3, 9000)]
    rng.shuffle(edges)
    label = {v: v for e in edges if e[0] != e[1] for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["id"]: r["component"] for r in components(df).collect()} == label
    assert components(df.limit(0)).count() == 0


def test_cells_travel_in_few_bytes():
    """Cells and their sets come back from the parts, at less than 12 bytes each."""
    rng = np.random.default_rng(3)
    cell = np.unique(rng.integers(0, 1 << 64, 200_000, dtype=np.uint64))
    ids = jaccard._short(rng.integers(-(1 << 63), 1 << 63, len(cell)))
    batch = jaccard._combined(np.concatenate([cell, cell[:500]]), np.concatenate([ids, ids[500:1000]]), 64)
    rows = batch.to_pylist()
    assert sum(len(x or b"") for r in rows for x in (r["cells"], r["a"], r["b"])) < 12 * len(cell)
    sent = [r for r in rows if r["cells"] is not None]
    got = [np.cumsum(jaccard._unpacked(r["cells"], r["size"]), dtype=np.uint64) for r in sent]
    assert np.array_equal(np.concatenate(got), cell >> np.uint64(16))
    pairs = {frozenset(p) for p in zip(ids[:500].tolist(), ids[500:1000].tolist(), strict=True)}
    for table in (pa.Table.from_batches([batch]), pa.Table.from_batches([batch, batch])):
        met = [b.to_pylist() for b in jaccard._near(iter(table.sort_by("part").to_batches()))]
        assert {frozenset((r["a"], r["b"])) for b in met for r in b} == pairs


def test_many_sets_do_not_move_all_texts(spark, monkeypatch):
    """Beyond what is broadcast, texts that give no wanted set stay where they are."""
    texts = spark.range(20_000).selectExpr("id AS __doc", "'some text' AS text")
    ids = texts.where("__doc % 10 = 0").select(F.col("__doc").alias("first_doc"))
    kept = jaccard._perhaps(texts, ids, 2000)
    assert kept.where("__doc % 10 = 0").count() == 2000
    assert kept.count() < 4000
    monkeypatch.setattr(jaccard, "BROADCAST_SETS", 0)
    rows = near_copies(40) + [(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "a b c d e f")]
    assert result(spark, rows, 3, 90) == brute_force(rows, 3, 90)


def test_stored_tables_leave_no_shuffle_files(spark):
    from pathlib import Path
    from time import monotonic, sleep

    from bazaarlens.operators.scratch import shuffles_dropped, stored

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for folder in disk.localDirsString() for f in Path(folder).rglob("shuffle_*")}

    before, setting = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with shuffles_dropped(spark):
        assert stored(spark.range(1000).repartition(7, "id")).count() == 1000
    until = monotonic() + 20
    while files() - before and monotonic() < until:
        sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
