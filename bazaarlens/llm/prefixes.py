"""Prefix trie of conversations, as a table of nodes with minimal perfect hashing.

A node is a distinct sequence of first turns. Its 128-bit digest is chained from its
parent's and the last turn's, so no text leaves the scan. Distinct digests are counted on
Spark. Sums over subtrees then need a node and its descendants together. A subtree may hold
a third of all conversations, so nodes are grouped by the size class of their member count
(``CLASS_BITS`` bits of it each). Connected nodes of one class are a component: at each
depth it has fewer than 2**``CLASS_BITS`` nodes, whatever the table holds. Components
are dealt to shards; classes are worked off from the smallest, and each hands what its
components sum up to, added per parent on Spark, to the next larger one.

Within a shard each digest gets a slot of a minimal perfect hash; the slot holds the digest,
so that foreign digests are told apart. Counts are scattered into flat arrays by slot and
added along the array of parent slots, deepest nodes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import filled, sorted_groups, table
from bazaarlens.operators.scratch import release, stored

#: Conversations take their first turns from the one whose id is the next lower multiple.
FAMILY, MOST_TURNS = 100, 6
#: Bits of a node's member count for each size class.
CLASS_BITS = 12
#: Nodes that a shard has on average.
SHARD = 100_000
#: Ids in one piece of a node's list of members that end there.
_PIECE = 512
_ROWS = 8192
_ROOT = bytes(16)
_NOBODY = hashlib.sha256(b"").hexdigest()


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), digest and code points of each turn.

    Turns are ordered by ``turn``, null first; equal ones by the digest of role and text.
    A null role or text is empty; rows without conv_id take no part; repeated rows are
    turns of their own; other columns are ignored.
    """
    role, text = filled("role"), filled("text")
    spelt = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(spelt, 256)), 1, 16)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return (
        conversations.where("conv_id IS NOT NULL")
        .select("conv_id", "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
        .select("conv_id", F.row_number().over(order).cast("long").alias("position"), "digest", "chars")
    )


def rebuilt(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with family openings, and the conv_id of every conversation.

    ``given``: result of ``turns``. The first h turns of c are those of conversation
    c - c % FAMILY (all if it has fewer, none if it is absent), then c's own follow after
    its first h; h is the CRC-32 of c's decimal form modulo MOST_TURNS. At most
    2 * FAMILY - 1 conversations share an opening.
    """
    taken = (F.crc32(F.col("conv_id").cast("string")) % MOST_TURNS).alias("taken")
    members = given.select("conv_id").distinct()
    openings = given.where((F.col("conv_id") % FAMILY == 0) & (F.col("position") < MOST_TURNS))
    borrowed = (
        members.select("conv_id", taken, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
        .join(openings.withColumnRenamed("conv_id", "base"), "base")
        .where("position <= taken")
        .select("conv_id", F.lit(0).alias("part"), "position", "digest", "chars")
    )
    own = given.where(F.col("position") > taken).select(
        "conv_id", F.lit(1).alias("part"), "position", "digest", "chars"
    )
    return borrowed.unionByName(own), members


_PATHS = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()),
     ("parent", pa.binary()), ("chars", pa.int64()), ("last", pa.bool_())]
)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's nodes; a row that starts it (without digest) is the root."""

    def walked() -> Iterator[tuple]:
        row = None
        for conv, digest, chars in _rows(batches):
            if digest is None:
                if row:
                    yield (*row, True)
                row = (conv, 0, _ROOT, None, 0)
                continue
            yield (*row, False)
            above = row[2]
            node = hashlib.blake2b(above + digest, digest_size=16).digest()
            row = (conv, row[1] + 1, node, above, chars)
        if row:
            yield (*row, True)

    return _batches(walked(), _PATHS)


def _paths(steps: DataFrame, members: DataFrame) -> DataFrame:
    none = [F.lit(-1).alias("part"), F.lit(0).cast("long").alias("position"),
            F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")]
    return (
        steps.unionByName(members.select("conv_id", *none))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "position")
        .select("conv_id", "digest", "chars")
        .mapInArrow(
            _chained,
            "conv_id long, depth long, node binary, parent binary, chars long, last boolean",
        )
    )


_TREE = pa.schema(
    [("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("chars", pa.int64()),
     ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
     ("class", pa.int32()), ("component", pa.binary()), ("up_class", pa.int32()),
     ("up_component", pa.binary())]
)
_TREE_DDL = (
    "node binary, parent binary, depth long, chars long, n_convs long, conv_id long, "
    "parent_conv_id long, class int, component binary, up_class int, up_component binary"
)


def _classed(bits: int):
    """Nodes with size class and component, from the path of their smallest member.

    A node's component is named by its highest node; that one also names the class and
    component of the node above, if there is one below the root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walked() -> Iterator[tuple]:
            of = above = component = up = None
            for conv, depth, node, parent, chars, smallest, n in _rows(batches):
                if conv != of:
                    of, above, component, up = conv, None, None, None
                level = (n.bit_length() - 1) // bits
                if above is None or above[0] != level:
                    up = (above[0], component) if above else (None, None)
                    component = node
                if smallest == conv:
                    tops = up if component == node else (None, None)
                    yield (node, parent, depth, chars, n, conv, above and above[1], level, component, *tops)
                above = (level, smallest)

        return _batches(walked(), _TREE)

    return run


class Slots:
    """A minimal perfect hash of distinct 128-bit digests, which it holds by slot.

    Levels of bit arrays: a digest stays on the first level where it has a bit to itself;
    its slot is the number of bits set before that one.
    """

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = np.zeros((len(digests), 2), np.uint64)
        left, start = digests, 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("two nodes have one digest")
            at = self._at(left, len(self.levels), 2 * len(left))
            single = np.bincount(at, minlength=2 * len(left)) == 1
            ranks = start + np.cumsum(single) - single
            alone = single[at]
            self.held[ranks[at[alone]]] = left[alone]
            self.levels.append((single, ranks))
            start += int(alone.sum())
            left = left[~alone]

    @staticmethod
    def _at(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = digests[:, 0] + digests[:, 1] * np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def of(self, digests: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 for those that the table doesn't hold."""
        found = np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for level, (single, ranks) in enumerate(self.levels):
            at = self._at(digests[open_], level, len(single))
            hit = single[at]
            found[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        held = found >= 0
        wrong = (self.held[found[held]] != digests[held]).any(axis=1)
        found[np.flatnonzero(held)[wrong]] = -1
        return found


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children, leaves and saved tokens of the nodes of each shard.

    Rows without ``depth`` are what finished components add to the node that they name.
    """
    for group in sorted_groups(batches, ["shard"]):
        known = pa.compute.is_valid(group["depth"])
        nodes, added = group.filter(known), group.filter(pa.compute.invert(known))
        slots = Slots(_digests(nodes["node"]))
        slot, above = slots.of(_digests(nodes["node"])), slots.of(_digests(nodes["parent"]))
        size = len(slot)
        depth, parent = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        saved, children, leaves = (np.zeros(size, np.int64) for _ in range(3))
        depth[slot], parent[slot] = _numbers(nodes["depth"]), above
        saved[slot] = (_numbers(nodes["n_convs"]) - 1) * _numbers(nodes["chars"])
        if added.num_rows:
            into = slots.of(_digests(added["node"]))
            for array, name in ((children, "children"), (leaves, "leaves"), (saved, "saved")):
                np.add.at(array, into, _numbers(added[name]))
        inside = parent >= 0
        children += np.bincount(parent[inside], minlength=size)
        leaves[children == 0] = 1
        order = np.argsort(-depth, kind="stable")
        edges = np.flatnonzero(np.diff(depth[order])) + 1
        for level in np.split(order, edges):
            level = level[parent[level] >= 0]
            np.add.at(leaves, parent[level], leaves[level])
            np.add.at(saved, parent[level], saved[level])
        done = nodes.select([f.name for f in _TREE])
        for name, array in (("n_children", children), ("n_leaves", leaves), ("saved_tokens", saved)):
            done = done.append_column(name, pa.array(array[slot]))
        yield from done.combine_chunks().to_batches(max_chunksize=_ROWS)


def _accumulated(tree: DataFrame) -> DataFrame:
    """``tree`` with n_children, n_leaves and saved_tokens of every node."""
    shards = tree.count() // SHARD + 1
    shard = F.pmod(F.xxhash64("component"), F.lit(shards)).alias("shard")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    done: list[DataFrame] = []
    for row in tree.select("class").distinct().orderBy("class").collect():
        given = tree.where(F.col("class") == row["class"]).select(shard, *tree.columns, *nothing)
        for before in done:
            handed = (
                before.where(F.col("up_class") == row["class"])
                .groupBy(F.col("parent").alias("node"), F.col("up_component").alias("component"))
                .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"),
                     F.sum("saved_tokens").alias("saved"))
            )
            given = given.unionByName(
                handed.select(shard, "node", "children", "leaves", "saved"), allowMissingColumns=True
            )
        sums = given.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            _summed, f"{_TREE_DDL}, n_children long, n_leaves long, saved_tokens long"
        )
        done.append(stored(sums))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of the ids of each node, at most ``_PIECE`` long, from sorted rows."""

    def joined() -> Iterator[tuple]:
        of, ids = None, []
        for node, conv in _rows(batches):
            if ids and (node != of or len(ids) == _PIECE):
                yield of, ids[0], ",".join(map(str, ids))
                ids = []
            of = node
            ids.append(conv)
        if ids:
            yield of, ids[0], ",".join(map(str, ids))

    return _batches(joined(), pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's list of ids, fed piece by piece."""

    def fed() -> Iterator[tuple]:
        of, digest = None, None
        for node, ids in _rows(batches):
            if node != of:
                if digest:
                    yield of, digest.hexdigest()
                of, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        if digest:
            yield of, digest.hexdigest()

    return _batches(fed(), pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))


def _ends(paths: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node; ids of a hot node are joined by many tasks.

    One task feeds a node's pieces to its digest, which can't be split, in bounded memory.
    """
    return (
        paths.where("last")
        .select("node", "conv_id")
        .repartitionByRange("node", "conv_id")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(_pieces, "node binary, first long, ids string")
        .repartition("node")
        .sortWithinPartitions("node", "first")
        .select("node", "ids")
        .mapInArrow(_hashed, "node binary, ends_sha256 string")
    )


def prefix_trie(steps: DataFrame, members: DataFrame, bits: int = CLASS_BITS) -> DataFrame:
    """One row for each distinct sequence of first turns, the empty one included.

    ``steps``: conv_id, part, position (their order), digest, chars; ``members``: conv_id
    of every conversation, those without turns included. Without members there is no node.
    Returns node (16-byte digest), conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256; turn ``depth`` of
    conversation ``conv_id`` is the node's last. Two sequences with one digest fail the job.
    """
    paths = stored(_paths(steps, members))
    below = paths.where("depth > 0")
    found = below.groupBy("node").agg(
        F.min("conv_id").alias("smallest"), F.count("*").alias("n_convs"),
        F.min("parent").alias("low"), F.max("parent").alias("high"),
    )
    same = F.when(F.col("low") == F.col("high"), F.col("n_convs")).otherwise(
        F.raise_error(F.lit("two sequences of turns have one digest")).cast("long")
    )
    nodes = stored(found.select("node", "smallest", same.alias("n_convs")))
    # copies of a conversation are nobody's smallest member and drop out here
    chosen = nodes.select(F.col("smallest").alias("conv_id")).distinct()
    tree = stored(
        below.join(chosen, "conv_id", "left_semi")
        .join(nodes, "node")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .select("conv_id", "depth", "node", "parent", "chars", "smallest", "n_convs")
        .mapInArrow(_classed(bits), _TREE_DDL)
    )
    release(nodes)
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    schema = ", ".join(["node binary", *[f"{name} long" for name in numbers]])
    top = paths.where("depth = 0").agg(F.min("conv_id"), F.count("*")).first()  # one row
    if tree.isEmpty():
        roots = [(_ROOT, top[0], 0, None, top[1], 0, 1, 0)] if top[1] else []
        rows = tree.sparkSession.createDataFrame(roots, schema)
    else:
        summed = _accumulated(tree)
        under = summed.where("depth = 1").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
        roots = [(_ROOT, top[0], 0, None, top[1], *under)]
        above = F.when(F.col("depth") == 1, F.lit(top[0])).otherwise(F.col("parent_conv_id"))
        rows = (
            summed.withColumn("parent_conv_id", above)
            .select("node", *numbers)
            .unionByName(tree.sparkSession.createDataFrame(roots, schema))
        )
    return rows.join(_ends(paths), "node", "left").select(
        "node", *numbers, F.coalesce("ends_sha256", F.lit(_NOBODY)).alias("ends_sha256")
    )


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    given = stored(turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(*rebuilt(given)).drop("node")
