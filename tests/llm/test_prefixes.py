import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import prefixes
from bazaarlens.llm.common import table

NUMBERS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=True):
    """Nodes of a trie built in plain Python, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            spelt = f"{len(role or '')}:{role or ''}{text or ''}".encode()
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(spelt).hexdigest()[:32],
                              (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6 if family else 0
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        told = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(told) + 1):
            members[told[:d]].append(c)
        ends[told].append(c)
    nodes = {}
    for p in sorted(members, key=len, reverse=True):
        children = [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p]
        nodes[p] = (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children),
            sum(nodes[q][5] for q in children) or 1,
            sum(nodes[q][6] for q in children) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0),
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
    return sorted(nodes.values(), key=str)


def found(spark, rows, bits=prefixes.CLASS_BITS):
    given = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    nodes = prefixes.prefix_trie(*prefixes.rebuilt(prefixes.turns(given)), bits=bits)
    return sorted((tuple(r) for r in nodes.select(*NUMBERS, "ends_sha256").collect()), key=str)


def test_given_conversations(spark):
    given = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, given) == brute(rows)


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_size_classes_hand_sums_upwards(spark, bits):
    """Many sharing conversations, worked off in one to ten classes."""
    rng = np.random.default_rng(5)
    rows = [
        (c, t, "user" if t % 2 == 0 else "assistant", "x" * int(rng.integers(1, 3)) + "é")
        for c in range(700)
        for t in range(int(rng.integers(1, 9)))
    ]
    assert found(spark, rows, bits) == brute(rows)


def test_a_hot_conversation_and_its_ids(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "_PIECE", 7)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 40000, 100) for t in range(3)]
    rows += [(c, 0, "user", f"own {c}") for c in range(50, 20000, 100)]
    assert found(spark, rows, 3) == brute(rows)


def test_a_very_long_conversation(spark):
    rows = [(0, t, "user", str(t // 2)) for t in range(900)] + [(1, 0, "user", "0" * 300_000)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody"), (0, None, "user", None), (0, 0, None, "a"), (0, 0, None, "a"),
        (0, 1, "user", ""), (-5, 0, "user", "n"), (-105, 2, "a", "b"), (-100, 1, "user", "n"),
        (7, None, None, None), (107, 1, "x", "tie"), (107, 1, "y", "tie"), (300, 5, "user", "a"),
        (301, 5, "user", "a"), (302, 5, "user", "a"), (2**62, 1, "u", "far"),
    ]
    assert found(spark, rows) == brute(rows)
    named = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"NODE": F.lit(1), "position": F.lit("p"), "digest": F.lit(2), "chars": F.lit(3)}
    )
    assert found(spark, named) == brute(rows)


def test_no_conversations_and_only_turnless_ones(spark):
    assert found(spark, spark.createDataFrame([], SCHEMA)) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    # 104 keeps what follows its first turns, and its family has none
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    assert found(spark, [(turnless, 0, "user", "x")]) == brute([(turnless, 0, "user", "x")])


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        digests = np.unique(rng.integers(0, 2**63, (n, 2)).astype(np.uint64), axis=0)
        digests[: n // 2, 1] = 7  # half a digest alone tells nothing
        slots = prefixes.Slots(digests)
        assert sorted(slots.of(digests)) == list(range(len(digests)))
        assert (slots.of(digests + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefixes.Slots(np.array([[1, 2], [1, 2]], np.uint64))


def test_two_sequences_with_one_digest_fail(spark, monkeypatch):
    class Same:
        def __init__(self, data, digest_size):
            self.data = data

        def digest(self):
            return hashlib.sha256(self.data).digest()[:16] if b"\0" * 8 in self.data else b"s" * 16

    rows = [(0, 0, "u", "a"), (0, 1, "u", "b"), (300, 0, "u", "c"), (300, 1, "u", "d")]
    steps, members = prefixes.rebuilt(prefixes.turns(spark.createDataFrame(rows, SCHEMA)))
    monkeypatch.setattr(prefixes, "hashlib", type("H", (), {"blake2b": Same, "sha256": hashlib.sha256}))
    with pytest.raises(Exception, match="one digest"):
        prefixes.prefix_trie(steps.withColumn("position", F.col("position")), members).collect()
