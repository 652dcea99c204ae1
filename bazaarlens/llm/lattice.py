"""Near-duplicate vectors by lattice hashing.

Each table projects unit vectors onto two random groups of eight directions, scales
them and decodes each group to the nearest point of the E8 lattice; the two points
name a cell. Close vectors mostly share a cell, or lie next to each other's: every
vector also probes the neighbouring cells nearest to it. Vectors that meet in a cell
are compared by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import components, sorted_groups, table
from bazaarlens.operators.scratch import stored

COSINE = 0.98
#: Tables, cells probed beside the own one, and units per unit of projected length.
TABLES, PROBES, SCALE = 8, 4, 3.0
GROUPS, SEED = 2, 20240131
#: Vectors of a cell that are compared in one piece.
PIECE = 1024


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers with an even sum), row by row."""
    near = np.rint(x)
    off = x - near
    odd = (near.sum(axis=1).astype(np.int64) & 1).astype(bool)
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    at = worst[rows]
    near[rows, at] += np.where(off[rows, at] >= 0, 1.0, -1.0)
    return near


def decoded(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, doubled so that they are whole numbers."""
    whole = nearest_even(x)
    half = nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(closer[:, None], half, whole)).astype(np.int64)


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: steps to neighbouring cells."""
    steps = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    steps.append(v)
    for bits in range(256):
        if bin(bits).count("1") % 2 == 0:
            steps.append([-1 if bits >> i & 1 else 1 for i in range(8)])
    return np.array(steps, np.int64)


def _named(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit names of rows of whole numbers."""
    name = np.full(len(points), 0x9E3779B97F4A7C15 ^ salt, np.uint64)
    with np.errstate(over="ignore"):
        for column in points.T:
            name = (name ^ column.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            name ^= name >> np.uint64(32)
    return name.view(np.int64)


def directions(size: int, number: int) -> np.ndarray:
    """Orthonormal directions of one table (as many as fit), by size and number."""
    random = np.random.default_rng([SEED, number, size])
    wanted = 8 * GROUPS
    matrix = random.standard_normal((size, wanted))
    if size >= wanted:
        matrix = np.linalg.qr(matrix)[0]
    else:
        matrix /= np.sqrt(size)
    return matrix * np.sqrt(size / wanted)


def cells(unit: np.ndarray, number: int, probes: int = PROBES) -> np.ndarray:
    """Names of each vector's own cell in a table and of the ``probes`` nearest others."""
    places = SCALE * (unit @ directions(unit.shape[1], number))
    points = [decoded(places[:, 8 * g : 8 * g + 8]) for g in range(GROUPS)]
    salt = number + 1
    names = [_named(np.hstack(points), salt)]
    if probes:
        steps = shortest()
        cost = []
        for g in range(GROUPS):
            rest = places[:, 8 * g : 8 * g + 8] - points[g] / 2
            # growth of the squared distance by a step: |s|^2 - 2 rest.s
            cost.append(2.0 - rest @ steps.T)
        cost = np.hstack(cost)
        nearest = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
        for p in range(probes):
            moved = [point.copy() for point in points]
            group, step = np.divmod(nearest[:, p], len(steps))
            for g in range(GROUPS):
                rows = np.flatnonzero(group == g)
                moved[g][rows] += steps[step[rows]]
            names.append(_named(np.hstack(moved), salt))
    return np.stack(names, axis=1)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _vectors(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every vector its cell names, and a row for each of them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rep = batch.column("rep").to_numpy()
        label = batch.column("label").to_numpy().astype(np.int64)
        sizes = np.array([len(v) for v in batch.column("unit")])
        for size in np.unique(sizes):  # vectors of unlike sizes never meet
            rows = np.flatnonzero(sizes == size)
            unit = _vectors(batch.column("unit").take(pa.array(rows)))
            salted = np.stack([label[rows], np.full(len(rows), size)], axis=1)
            salt = _named(salted, 77).view(np.uint64)
            names = [
                (cells(unit, t).view(np.uint64) ^ salt[:, None]).view(np.int64)
                for t in range(TABLES)
            ]
            codes = np.ascontiguousarray(np.hstack(names))
            each = codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(codes.ravel()),
                    pa.array(np.repeat(rep[rows], each)),
                    pa.array(np.tile(np.arange(each) // (PROBES + 1), len(rows)).astype(np.int32)),
                    pa.array(np.tile(np.arange(each) % (PROBES + 1) == 0, len(rows))),
                ],
                names=["cell", "rep", "number", "home"],
            )


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same cell names, one row of ``TABLES`` times one and ``PROBES`` for a vector."""
    each = TABLES * (PROBES + 1)
    for batch in batches:
        for entry in _entries(iter([batch])):
            names = entry.column("cell").to_numpy().reshape(-1, each)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(entry.column("rep").to_numpy()[::each]),
                    pa.array([row.tobytes() for row in names], pa.binary()),
                ],
                names=["rep", "codes"],
            )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each piece of a cell, as counts per vector and spanning edges."""
    for group in sorted_groups(batches, ["cell", "low", "high"]):
        group = group.combine_chunks()
        first = {c: group.column(c)[0].as_py() for c in ("number", "low", "high")}
        rep = group.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        group, rep = group.take(pa.array(order)), rep[order]
        label = group.column("label").to_numpy()
        home = group.column("home").to_numpy(zero_copy_only=False).astype(bool)
        copies = group.column("copies").to_numpy()
        piece = group.column("piece").to_numpy()
        sizes = np.array([len(v) for v in group.column("unit").to_pylist()])
        if (sizes != sizes[0]).any():
            raise ValueError("two cells of vectors of unlike sizes have one name")
        unit = _vectors(group.column("unit"))
        close = unit @ unit.T >= COSINE
        close &= home[:, None] | home[None, :]
        close &= label[:, None] == label[None, :]
        if first["low"] != first["high"]:
            close &= piece[:, None] != piece[None, :]
        a, b = np.nonzero(np.triu(close, 1))
        different = rep[a] != rep[b]
        a, b = a[different], b[different]
        if not len(a):
            continue
        # a pair counts where it meets first: by table, then in the first one's cell
        codes = np.stack([np.frombuffer(c, np.int64) for c in group.column("codes").to_pylist()])
        codes = codes.reshape(len(rep), TABLES, PROBES + 1)
        new = np.ones(len(a), bool)
        t = first["number"]
        for earlier in range(t):
            of_a, of_b = codes[a, earlier], codes[b, earlier]
            new &= ~((of_a[:, :1] == of_b).any(axis=1) | (of_b[:, :1] == of_a).any(axis=1))
        of_a, of_b = codes[a, t], codes[b, t]
        here = group.column("cell")[0].as_py()
        new &= (of_a[:, 0] == here) | ~(of_a[:, :1] == of_b).any(axis=1)
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, a[new], copies[b[new]])
        np.add.at(links, b[new], copies[a[new]])
        label_of = local_components(len(rep), a, b)
        rows = np.flatnonzero((links > 0) | (label_of != np.arange(len(rep))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[rows]), pa.array(rep[label_of[rows]]), pa.array(links[rows])],
            names=["rep", "low_rep", "links"],
        )


def near_duplicates(df: DataFrame) -> DataFrame:
    """``df`` (vec_id, embedding, label) with n_links, component_id and kept.

    Vectors of equal, not null label link at a cosine of at least ``COSINE``, also
    copies, also rows with equal vec_id. A vector that is null, empty or zero or holds
    null or non-finite components, and one without label or vec_id, links with nothing
    and is its own component. One row for each row; an empty table stays empty; more
    columns are left out. Equal vectors are compared once. A cell with very many
    vectors is dealt out in pairs of pieces.
    """
    given = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    # a first division by the largest component keeps squares in range
    largest = F.array_max(F.transform("embedding", F.abs))
    fit = (
        given.where(F.coalesce(usable, F.lit(False)) & (F.size("embedding") > 0))
        .withColumn("embedding", F.transform("embedding", lambda x: F.try_divide(x, largest)))
        .where(norm > 0)
        .select("vec_id", "label", F.transform("embedding", lambda x: F.try_divide(x, norm)).alias("unit"))
    )
    fit = stored(fit)
    # a class of equal vectors has a number of its own: a vec_id may have several vectors
    classes = stored(
        fit.groupBy("label", "unit")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    reps = classes.select("rep", "label", "unit")
    entries = reps.mapInArrow(_entries, "cell long, rep long, number int, home boolean")
    entries = stored(entries)
    met = (
        entries.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("any_home"))
        .where("size > 1 AND any_home")
        .select("cell", F.ceil(F.col("size") / PIECE).cast("int").alias("pieces"))
    )
    payload = stored(
        reps.mapInArrow(_codes, "rep long, codes binary").join(classes.drop("first_id"), "rep")
    )
    pieces = F.col("pieces")
    own = F.pmod(F.xxhash64("rep"), pieces).cast("int")
    dealt = (
        entries.join(met, "cell")
        .withColumn("piece", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .select(
            "cell", "number", "home", "rep", "piece",
            F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"),
        )
    )
    links = stored(
        dealt.join(payload, "rep")
        .repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_linked, "rep long, low_rep long, links long")
    )
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(links.select(F.col("rep").alias("a"), F.col("low_rep").alias("b")))
    of_class = classes.join(counts, "rep", "left").join(
        found.withColumnRenamed("id", "rep"), "rep", "left"
    )
    of_class = of_class.select(
        "label",
        "unit",
        "first_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    names = of_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = of_class.join(names, "component").drop("component", "first_id")
    linked = fit.join(of_class, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    # one line per row: rows that take part, and the others
    others = given.where(
        ~(F.coalesce(usable, F.lit(False)) & (F.size("embedding") > 0)) | (F.coalesce(largest, F.lit(0.0)) == 0)
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept"
    )
