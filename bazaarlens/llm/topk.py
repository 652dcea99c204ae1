"""Exact top-k search by an impact-ordered index, one level of impact at a time.

A block of vectors is indexed by postings (dimension, vector, impact), put into
segments of equal quantised impact: the bit length of the component's size. For a
block of queries the segments are processed from the highest impact down, adding to
one accumulator per query and vector. After each level the norm of what is left of a
vector bounds its score from both sides; a query is done when the bounds prove which
vectors can still be among its best, and few are left. Those are scored again exactly,
in whole numbers. Every block is searched for every query; the k best of the blocks
give the k best of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import batches_of, sorted_groups, table
from bazaarlens.operators.scratch import stored

#: Vectors and queries in a block, on average; blocks that a task gets in one Arrow batch.
BLOCK, QUERY_BLOCK = 8192, 1024
BATCH = 4
#: Sums of squares of a vector's whole numbers stay below this, so a score fits 64 bits.
LARGEST = 1 << 62
#: A level is the last if so small a share of all pairs is left to score exactly.
FEW = 0.02


def _matrix(vectors: list[bytes]) -> np.ndarray:
    """Whole-number vectors as rows, shorter ones filled up with zeros."""
    rows = [np.frombuffer(v, np.int64) for v in vectors]
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a block: its ids and vectors, side by side."""
    for group in sorted_groups(batches, ["block"]):
        matrix = _matrix(group.column("vector").to_pylist())
        ids = np.array(group.column("vec_id").to_pylist(), np.int64)
        order = np.argsort(ids, kind="stable")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([group.column("block")[0].as_py()], pa.int32()),
                pa.array([ids[order].tobytes()], pa.binary()),
                pa.array([matrix[order].tobytes()], pa.binary()),
            ],
            names=["block", "ids", "vectors"],
        )


class Index:
    """Segments of one block's postings, by falling impact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        impact = np.frexp(np.abs(vectors).astype(np.float64))[1]  # bit length
        impact[vectors == 0] = 0
        self.segments = []
        rest = (vectors.astype(np.float64) ** 2).sum(axis=1)
        for level in range(int(impact.max(initial=0)), 0, -1):
            at_level = impact == level
            if not at_level.any():
                continue
            segment = np.where(at_level, vectors, 0).astype(np.float64)
            rest = np.maximum(rest - (segment**2).sum(axis=1), 0.0)
            # the norm of all postings of lower impact, by vector
            self.segments.append((segment, np.sqrt(rest)))

    def search(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
        """(query, score, vector) of the k best of each query, its own row left out."""
        q = queries.astype(np.float64)
        norms = np.sqrt((q**2).sum(axis=1))
        scores = np.zeros((len(q), len(ids)))
        own = query_ids[:, None] == ids[None, :]
        possible = ~own
        widest = np.abs(self.vectors).max(initial=0)
        slack = 1e-9 * norms * (widest * np.sqrt(q.shape[1]) + 1)
        for segment, rest in self.segments:
            scores += q @ segment.T
            bound = norms[:, None] * rest[None, :] + slack[:, None]
            least = np.where(own, -np.inf, scores - bound)
            if least.shape[1] >= k:
                # at least k vectors score no less than this
                floor = -np.partition(-least, k - 1, axis=1)[:, k - 1]
                possible = ~own & (scores + bound >= floor[:, None])
                if possible.sum() <= FEW * possible.size:
                    break
        a, b = np.nonzero(possible)
        exact = np.empty(len(a), np.int64)
        for i in range(0, len(a), 1 << 17):
            part = slice(i, i + (1 << 17))
            exact[part] = np.einsum(
                "ij,ij->i", queries[a[part]], self.vectors[b[part]]
            )
        order = np.lexsort((ids[b], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        best = rank < k
        return a[best], exact[best], ids[b[best]]


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best-scoring other rows of each query row: query_id, rank, vec_id, score.

    A vector is ``floor(scale * x)`` of its ``embedding``, a score the inner product,
    ties go to the smaller vec_id. Rows whose vec_id is null or whose embedding is
    null or empty or holds null or non-finite components take no part. A vector so long
    that its scores may not fit 64 bits (``LARGEST``) fails the job; missing components of
    shorter vectors count 0.
    Rows of equal vec_id are one another's own; as queries they get one answer, for
    the least of their vectors. Fewer than k others give fewer rows,
    an empty table none; more columns are ignored.
    """
    usable = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & (F.size("embedding") > 0),
        F.lit(False),
    )
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    squares = F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x)
    whole = F.when(squares < float(LARGEST), scaled.cast("array<bigint>")).otherwise(
        F.raise_error(F.lit("scores of a vector do not fit 64 bits")).cast("array<bigint>")
    )
    vectors = (
        df.withColumn("__query", F.coalesce(is_query, F.lit(False)))
        .where(usable)
        .select("vec_id", whole.alias("vector"), "__query")
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("vector").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([np.array(r, np.int64).tobytes() for r in rows], pa.binary()),
                    batch.column("__query"),
                ],
                names=["vec_id", "vector", "query"],
            )

    ready = stored(vectors.mapInArrow(packed, "vec_id long, vector binary, query boolean"))
    counts = ready.agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q")).first()
    blocks = max(1, -(-counts["n"] // block))
    query_blocks = max(1, -(-counts["q"] // query_block))

    def dealt(rows: DataFrame, number: int) -> DataFrame:
        place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(number)).cast("int")
        return stored(
            rows.withColumn("block", place)
            .repartition(number, "block")
            .sortWithinPartitions("block")
            .select("block", "vec_id", "vector")
            .mapInArrow(_gathered, "block int, ids binary, vectors binary")
        )

    index = dealt(ready, blocks)
    asked_once = ready.where("query").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = dealt(asked_once, query_blocks)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Answers of each block; its vectors come first, then one block of queries after another."""
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], np.int64)
                given = np.frombuffer(row["vectors"], np.int64).reshape(len(own), -1)
                if not row["query"]:
                    ids, vectors = own, given
                    found = Index(vectors)
                    continue
                query_ids, asked = own, given
                width = max(vectors.shape[1], asked.shape[1])
                if vectors.shape[1] < width:
                    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
                    found = Index(vectors)
                asked = np.pad(asked, ((0, 0), (0, width - asked.shape[1])))
                for i in range(0, len(asked), 256):
                    a, score, vec = found.search(
                        ids, asked[i : i + 256], query_ids[i : i + 256], k
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[i : i + 256][a]), pa.array(vec), pa.array(score)],
                        names=["query_id", "vec_id", "score"],
                    )

    # every block of queries goes to every block of the index, which moves once; no join,
    # as its planner would take the queries for as small as they are before that
    every = queries.select("ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    met = index.select("block", F.lit(False).alias("query"), "ids", "vectors").unionByName(
        every.withColumn("query", F.lit(True))
    )
    with batches_of(df.sparkSession, BATCH):
        best = stored(
            met.repartition("block")
            .sortWithinPartitions("block", "query")
            .select("query", "ids", "vectors")
            .mapInArrow(searched, "query_id long, vec_id long, score long")
        )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best of every row whose vec_id is divisible by 50, among all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
