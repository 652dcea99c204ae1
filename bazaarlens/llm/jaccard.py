"""N-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance is a metric, but a sparse one: nearly every document is at
distance 1 from nearly every other, so that Voronoi regions around document pivots
alone would be replicated everywhere. The join therefore goes from coarse to fine, and
the triangle inequality proves each step complete.

1. Sets are projected onto parts of the universe of shingles, more parts than linked
   sets can differ in. The differences of the parts add up, so linked sets agree wholly
   on some parts: each distinct projection is a pivot there, its region the sets at
   distance 0. Projections hardly larger than a shingle are left out, as many as there
   are parts to spare. Shingles that are common in a sample belong to no part: leaving
   them out brings sets only closer, and passages that many documents share make no
   regions. Sizes bound the difference; sets near the end of a band of sizes are
   replicated to the next band. Regions that share sets are joined.
2. A region too large for one task is divided by document pivots: each set goes to the
   Voronoi region of its nearest pivot and there into a ring of one radius' width.
   Boundary sets are replicated to all regions and rings that the windows of the
   triangle inequality allow. Sets far from all pivots form a region of their own.
   Rings that are still too large are divided again by other pivots. Sets linked to one
   pivot, or to pivots that a set is linked to at once, belong together already: they are
   compared with others only, and a ring of none but such sets is done.
3. What pivots cannot divide, or only into more than it was, is dealt out in pairs of
   pieces: those of sets that are still open with each other and with the rest.

Regions, rings and pieces are joined exactly on shingle sets. Sets equal to one another
take part once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import batches_of, components, filled, sliced, sorted_groups, table
from bazaarlens.llm.lattice import local_components
from bazaarlens.operators.scratch import release, stored

#: Words in a shingle; sets link at ``LEAST`` hundredths of Jaccard similarity.
WORDS, LEAST = 3, 90
#: Sets, and shingles in all of them, that one task joins at once.
MOST_SETS, MOST_SHINGLES = 512, 1_500_000
#: Pivots tried per region, divisions one after another, distance that counts as far.
PIVOTS, LEVELS, FAR = 12, 2, 0.6
#: Ratio of the sizes at the ends of a band; parts beyond those that linked sets can
#: differ in, at least and as a share of those.
BAND, SPARE, SPARE_SHARE = 1.5, 2, 0.3
#: Documents sampled, about, to find common shingles, and how many of them hold one.
SAMPLE, COMMON = 32768, 10
#: Rows of an Arrow batch where each carries a set.
WIDE_ROWS = 256
#: Sets of a large region that are compared with its pivots in one go.
STRETCH = 512
#: Regions of sets are looked up by broadcast up to so many sets. Beyond, texts are joined
#: whose hashed ids have their bit among so many for each set, and so many (64 a row) at most.
BROADCAST_SETS = 500_000
BITS_A_SET, MOST_BITS = 16, 1 << 27
#: Bits kept of a cell and of a set's digest where cells are matched. What falls together
#: by that only shares a region.
CELL_BITS, SHORT_BITS = 48, 40
#: Cells that a task holds before it sends them, and bytes of text for each part of them.
HELD_CELLS, PART_BYTES, LEAST_PARTS = 1 << 20, 8 << 20, 32
_REMEMBERED = 200_000
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M[2]
        x = (x ^ (x >> np.uint64(29))) * _M[1]
        return x ^ (x >> np.uint64(32))


def shingler(words: int = WORDS) -> Callable[[str], np.ndarray]:
    """A function from a text to the sorted 64-bit digests of its distinct shingles."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest

    class Memory(dict):
        def __missing__(self, word: bytes) -> int:
            value = digest(word)
            if len(word) <= 64:
                if len(self) >= _REMEMBERED:
                    self.clear()
                self[word] = value
            return value

    of = Memory().__getitem__

    def shingles(text: str) -> np.ndarray:
        # bytes are lower-cased and split in ASCII only
        found = text.encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.empty(0, np.uint64)
        coded = np.fromiter(map(of, found), np.uint64, len(found))
        width = min(words, len(coded))
        with np.errstate(over="ignore"):
            value = np.full(len(coded) - width + 1, width, np.uint64)
            for i in range(width):
                value = (value + coded[i : len(coded) - width + 1 + i]) * _M[i % 3]
                value ^= value >> np.uint64(31)
        return np.unique(value)

    return shingles


def set_id(shingles: np.ndarray) -> int:
    """64-bit digest of a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def band_starts(upto: int, least: int = LEAST) -> list[int]:
    """First size of every band, to one beyond ``upto``."""
    starts = [1, -(-least // (100 - least)) + 1]
    while starts[-1] <= upto:
        starts.append(int(np.ceil(starts[-1] * max(BAND, 100 / least))))
    return starts


def most_difference(a: int, b: int, least: int = LEAST) -> int:
    """Most shingles in which linked sets of sizes a and b differ."""
    # |a & b| >= least / (100 + least) * (a + b)
    return (a + b) * (100 - least) // (100 + least)


def signatures(
    shingles: np.ndarray, least: int = LEAST, common: np.ndarray | None = None
) -> np.ndarray:
    """Names of the pivots a set coincides with on parts of the universe.

    A set takes part in its own band of sizes and, if a set of the band below can be
    similar enough, in that one too. Linked sets agree on more parts than there are
    spare ones. A set leaves out its smallest parts, as many as are spare: of two sets
    one leaves out all that the other does, so some part on which they agree is named
    by both.
    """
    n = len(shingles)
    starts = band_starts(n, least)
    home = int(np.searchsorted(starts, n, side="right")) - 1
    bands = [home]
    if home > 0 and n * least <= (starts[home] - 1) * 100:
        bands.append(home - 1)
    if n == 0 or (home == 0 and n * 100 < starts[1] * least):
        return np.empty(0, np.int64)  # nothing but an equal set is similar enough
    rare = shingles
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rare = shingles[common[at] != shingles]
    strong = _mixed(rare)
    names = []
    for band in bands:
        largest = starts[band + 1] - 1
        differ = most_difference(largest, largest * 100 // least, least)
        spare = SPARE + int(SPARE_SHARE * differ)
        parts = differ + 1 + spare
        part = ((strong >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(sums, part, _mixed(strong + _M[0]))
            salted = _mixed(
                sums ^ _mixed(np.arange(parts, dtype=np.uint64) * _M[0] + np.uint64(band + 1))
            )
        held = np.bincount(part, minlength=parts)
        # parts smaller than this are no more than are spare
        small = np.partition(held, spare)[spare]
        names.append(salted[held >= small])
    return np.concatenate(names).view(np.int64)


def _sampled(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets of some documents."""
        shingles = shingler(words)
        for batch in sliced(batches):
            found = [shingles(text) for text in batch.column("text").to_pylist()]
            found = [s for s in found if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in found], pa.int64()),
                    pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                ],
                names=["set_id", "shingles"],
            )

    return run


def common_shingles(df: DataFrame, words: int, rows: int | None = None) -> np.ndarray:
    """Shingles that ``COMMON`` different sets of about ``SAMPLE`` documents hold, sorted.

    There are fewer of them than the sample has shingles, by that factor. They only
    serve to keep regions small; the join is exact for any choice of them. ``rows``: those
    of ``df``, where they have been counted.
    """
    share = SAMPLE / max(1, df.count() if rows is None else rows)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    found = (
        df.where(draw)
        .select(filled().alias("text"))
        .mapInArrow(_sampled(words), "set_id long, shingles array<long>")
        .dropDuplicates(["set_id"])
        .select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .count()
        .where(F.col("count") >= COMMON)
        .select("shingle")
        .toArrow()
    )
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes, all lowest bytes first, without the places that are 0 in all."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    places = np.zeros((size, 8), np.uint8)
    if size:
        places[:, : len(data) // size] = np.frombuffer(data, np.uint8).reshape(-1, size).T
    return places.reshape(-1).view("<u8")


def _short(set_ids: np.ndarray) -> np.ndarray:
    return set_ids.view(np.uint64) >> np.uint64(64 - SHORT_BITS)


def _distinct(pairs: np.ndarray) -> np.ndarray:
    """Pairs (columns) in order, each once."""
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    return pairs[:, np.r_[True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)][: pairs.shape[1]]]


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("part", pa.int32()),
     ("size", pa.int32()), ("cells", pa.binary()), ("a", pa.binary()), ("b", pa.binary())]
)
_SKETCH_DDL = "doc_id long, n_shingles long, set_id long, part int, size int, cells binary, a binary, b binary"


def _combined(cell: np.ndarray, ids: np.ndarray, parts: int) -> pa.RecordBatch:
    """One set for each of a task's cells, by part, and how its other sets meet it.

    A part is a range of cells. Rows without ``cells`` are pairs of sets that have met;
    the sets of the others are to be met by other tasks. However many sets share a cell,
    little of it leaves a task.
    """
    order = np.lexsort((ids, cell))
    cell, ids = cell[order], ids[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
    pivot = np.repeat(ids[first], np.diff(np.r_[first, len(cell)]))
    met = _distinct(np.stack([ids, pivot])[:, ids != pivot])
    cell, ids = cell[first], ids[first]
    part = ((cell >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cell = cell >> np.uint64(64 - CELL_BITS)
    cuts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)]), len(part)]
    rows = []
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        steps = _packed(np.diff(cell[start:stop], prepend=np.uint64(0)))
        rows.append((int(part[start]), stop - start, steps, _packed(ids[start:stop]), None))
    for start in range(0, met.shape[1], 1 << 16):
        a, b = met[:, start : start + (1 << 16)]
        rows.append((int(a[0]) % parts, len(a), None, _packed(a), _packed(b)))
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    empty = pa.nulls(len(rows), pa.int64())
    arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_SKETCH)[3:], strict=True)]
    return pa.RecordBatch.from_arrays([empty, empty, empty, *arrays], schema=_SKETCH)


def _sketched(words: int, least: int, common: Broadcast, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's size and set, as rows without ``part``, and all cells by part."""
        shingles = shingler(words)
        cells: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = 0

        def sent() -> pa.RecordBatch:
            return _combined(np.concatenate(cells).view(np.uint64), np.concatenate(owners), parts)

        for batch in sliced(batches):
            sizes, ids = [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                ids.append(set_id(found) if len(found) else None)
                if not len(found):
                    continue
                cells.append(signatures(found, least, common.value))
                owners.append(np.repeat(_short(np.array(ids[-1:], np.int64)), len(cells[-1])))
                held += len(cells[-1])
                if held >= HELD_CELLS:
                    yield sent()
                    cells, owners, held = [], [], 0
            given = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())]
            none = [pa.nulls(len(sizes), f.type) for f in list(_SKETCH)[3:]]
            yield pa.RecordBatch.from_arrays([*given, *none], schema=_SKETCH)
        if held:
            yield sent()

    return run


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets that share a cell with its first set; rows are sorted by part."""
    for group in sorted_groups(batches, ["part"]):
        met, cells, ids = [np.zeros((2, 0), np.uint64)], [], []
        columns = [group.column(c).to_pylist() for c in ("size", "cells", "a", "b")]
        for size, steps, a, b in zip(*columns, strict=True):
            if steps is None:
                met.append(np.stack([_unpacked(a, size), _unpacked(b, size)]))
            else:
                cells.append(np.cumsum(_unpacked(steps, size), dtype=np.uint64))
                ids.append(_unpacked(a, size))
        if cells:
            cell, own = np.concatenate(cells), np.concatenate(ids)
            order = np.argsort(cell, kind="stable")
            cell, own = cell[order], own[order]
            new = np.r_[True, cell[1:] != cell[:-1]]
            pivot = own[np.maximum.accumulate(np.where(new, np.arange(len(cell)), 0))]
            met.append(np.stack([own, pivot])[:, own != pivot])
        known = _distinct(np.hstack(met)).astype(np.int64)
        if known.shape[1]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[0]), pa.array(known[1])], names=["a", "b"]
            )


def _region_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["region", "set_id", "n", "shingles", "linked"],
    )


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles of sets that lie in a region."""
        shingles = shingler(words)
        for batch in sliced(batches):
            rows = []
            for text, wanted, region in zip(
                *[batch.column(c).to_pylist() for c in ("text", "set_id", "region")], strict=True
            ):
                found = shingles(text)
                # another row of the same doc_id may hold another text
                if len(found) and set_id(found) == wanted:
                    rows.append((region, wanted, len(found), found.tobytes(), None))
            yield _region_batch(rows)

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a few sets."""
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    # shingles held by the same sets are counted together
    random = np.random.default_rng(m).integers(0, 1 << 63, m, dtype=np.uint64)
    held_by = np.zeros(column.max(initial=0) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(held_by, column, random[owner])
    _, first, pattern, weight = np.unique(
        held_by, return_index=True, return_inverse=True, return_counts=True
    )
    chosen = np.zeros(len(held_by), bool)
    chosen[first] = True
    use = chosen[column]
    owner, pattern = owner[use], pattern[column[use]]
    order = np.argsort(pattern, kind="stable")
    owner, pattern = owner[order], pattern[order]
    out = np.zeros((m, m), np.float64)
    for start in range(0, len(weight), 2048):
        stop = min(start + 2048, len(weight))
        a, b = np.searchsorted(pattern, [start, stop])
        part = np.zeros((m, stop - start), np.float32)
        part[owner[a:b], pattern[a:b] - start] = 1.0
        # whole numbers below 2**24 are exact
        heavy = part * weight[start:stop].astype(np.float32)
        out += heavy @ part.T
    return np.rint(out).astype(np.int64)


def _joined(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spanning edges of the links inside each region, ring or pair of pieces."""
        for group in sorted_groups(batches, ["region", "low", "high"]):
            ids = np.array(group.column("set_id").to_pylist(), np.int64)
            if len(ids) < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            both = overlaps(sets)
            union = size[:, None] + size[None, :] - both
            a, b = np.nonzero(np.triu(100 * both >= least * union, 1))
            low = local_components(len(ids), a, b)
            rows = np.flatnonzero(low != np.arange(len(ids)))
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(ids[low[rows]])], names=["a", "b"]
                )

    return run


def _spread(sets: list[np.ndarray], radius: float) -> list[int]:
    """Pivots more than three radii apart, the most central first."""
    size = np.array([len(s) for s in sets])
    both = overlaps(sets) if len(sets) > 1 else size[:, None]
    distance = 1 - both / (size[:, None] + size[None, :] - both)
    chosen: list[int] = []
    for i in np.argsort(distance.sum(axis=1), kind="stable"):
        if all(distance[i, j] > 3 * radius + 1e-9 for j in chosen):
            chosen.append(int(i))
    return chosen


def _divided(least: int, level: int):
    radius = 1 - least / 100
    tiny = 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rings of each set, and its links to pivots (as rows without region).

        The sets tried as pivots come before a region's sets, and sets are linked to any of
        them. A linked set carries the name of the first from then on; rows without region
        that carry one too say that two such names belong together.
        """
        stretch, ready, names, chosen, bridged = None, False, [], [], set()
        tried: list[tuple[int, np.ndarray]] = []
        out: list[tuple] = []
        for batch in sliced(batches):
            for row in batch.to_pylist():
                region = row["region"]
                if (region, row["stretch"]) != stretch:
                    stretch, ready, tried, bridged = (region, row["stretch"]), False, [], set()
                if row["pivot"]:
                    tried.append((row["set_id"], np.frombuffer(row["shingles"], np.uint64)))
                    continue
                if not ready:
                    ready = True
                    chosen = _spread([s for _, s in tried], radius)
                    names = [name for name, _ in tried]
                own = np.frombuffer(row["shingles"], np.uint64)
                both = np.array([len(np.intersect1d(own, p, assume_unique=True)) for _, p in tried])
                union = len(own) + np.array([len(p) for _, p in tried]) - both
                linked = row["linked"]
                near = [names[i] for i in np.flatnonzero(100 * both >= least * union)]
                if near and near[0] != row["set_id"]:
                    out.append((None, row["set_id"], near[0], None, None))
                if linked is None and near:
                    linked = near[0]
                for name in near:
                    if name != linked and (linked, name) not in bridged:
                        bridged.add((linked, name))
                        out.append((None, linked, name, None, linked))
                distance = (1 - both / union)[chosen]
                nearest = distance.min()

                def put(number: int, ring: int, row=row, region=region, out=out, linked=linked) -> None:
                    name = np.array([region, number, ring, level], np.int64).view(np.uint64)
                    mixed = _mixed(_mixed(_mixed(_mixed(name[:1]) + name[1:2]) + name[2:3]) + name[3:4])
                    name = int(mixed.view(np.int64)[0])
                    out.append((name, row["set_id"], row["n"], row["shingles"], linked))

                if nearest >= FAR - radius - tiny:
                    put(-1, -1)
                window = min(nearest + 2 * radius, FAR + radius) + tiny
                for i in np.flatnonzero(distance <= window):
                    first = int(np.floor((distance[i] - radius - tiny) / radius))
                    last = int(np.floor((distance[i] + radius + tiny) / radius))
                    # all sets within the first ring are linked to the pivot, and
                    # first rings of two pivots are too far apart for links
                    for ring in range(max(1, first), last + 1):
                        if ring * radius < FAR + tiny:
                            put(i, ring)
                if len(out) >= STRETCH:
                    yield _region_batch(out)
                    out.clear()
        yield _region_batch(out)

    return run


_REGION = "region long, set_id long, n long, shingles binary, linked long"


def _sized(regions: DataFrame) -> DataFrame:
    """Regions with something to compare: ``home``, pieces of sets that are open and not.

    Sets with the commonest name in ``linked`` are linked to one pivot and not compared with
    each other. All others are open.
    """
    alike = regions.groupBy("region", "linked").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("all_shingles")
    )
    known = F.col("linked").isNotNull()
    totals = alike.groupBy("region").agg(
        F.max_by("linked", F.when(known, F.struct("sets", "linked"))).alias("home"),
        F.max(F.when(known, F.struct("sets", "linked", "all_shingles"))).alias("closed"),
        F.sum("sets").alias("sets"),
        F.sum("all_shingles").alias("all_shingles"),
    )

    def pieces(sets: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(sets / MOST_SETS), F.ceil(shingles / MOST_SHINGLES)).cast("int")

    sets, shingles = F.coalesce("closed.sets", F.lit(0)), F.coalesce("closed.all_shingles", F.lit(0))
    sized = totals.where((F.col("sets") > 1) & (F.col("sets") > sets)).select(
        "region",
        "home",
        "sets",
        sets.alias("closed"),
        pieces(F.col("sets") - sets, F.col("all_shingles") - shingles).alias("open"),
        pieces(sets, shingles).alias("shut"),
    )
    # rows that dealing out makes of the region
    meet = (F.col("sets") - F.col("closed")) * (F.col("open") + F.col("shut"))
    return sized.select("*", (meet + F.col("closed") * F.col("open")).alias("rows"))


def _dealt(regions: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sets dealt to pairs of pieces (low, high), at least one of which is of open sets."""
    shut = F.col("linked").isNotNull() & F.col("linked").eqNullSafe(F.col("home"))
    drawn = F.xxhash64("set_id")
    open_piece = F.pmod(drawn, F.col("open")).cast("int")
    shut_piece = (F.col("open") + F.pmod(drawn, F.greatest("shut", F.lit(1)))).cast("int")
    piece = F.when(shut, shut_piece).otherwise(open_piece)
    last = F.when(shut, F.col("open")).otherwise(F.col("open") + F.col("shut")) - 1
    return (
        regions.join(sizes.select("region", "home", "open", "shut"), "region")
        .withColumn("piece", piece)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
        .select(
            "region", "set_id", "shingles",
            F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"),
        )
    )


def _links(regions: DataFrame, least: int) -> list[DataFrame]:
    """Spanning edges (a, b) of all links within regions."""
    edges = []

    def join(sizes: DataFrame) -> None:
        edges.append(
            stored(
                _dealt(regions, sizes)
                .repartition("region", "low", "high")
                .sortWithinPartitions("region", "low", "high", "set_id")
                .mapInArrow(_joined(least), "a long, b long")
            )
        )

    def rows(sizes: DataFrame) -> int:
        return sizes.agg(F.sum("rows")).first()[0] or 0

    sizes = stored(_sized(regions))
    for level in range(LEVELS + 1):
        # few open sets meet any number of others without being divided
        large = sizes.where("open > 1")
        join(sizes.where("open = 1"))
        if large.isEmpty():
            return edges
        if level == LEVELS:
            join(large)
            return edges
        # each stretch of a region is led by a copy of the region's pivots
        stretches = large.select("region", F.ceil(F.col("sets") / STRETCH).cast("int").alias("stretches"))
        many = stored(regions.join(stretches, "region"))
        # new pivots are sets that no pivot is linked to, where there are any
        drawn = F.xxhash64("set_id", F.lit(level))
        order = Window.partitionBy("region").orderBy(F.col("linked").isNotNull(), drawn)
        pivots = many.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
        led = many.select(
            "region", "set_id", "n", "shingles", "linked", F.lit(False).alias("pivot"),
            F.pmod(F.xxhash64("set_id"), F.col("stretches")).cast("int").alias("stretch"),
        ).unionByName(
            pivots.select(
                "region", "set_id", "n", "shingles", "linked", F.lit(True).alias("pivot"),
                F.explode(F.sequence(F.lit(0), F.col("stretches") - 1)).alias("stretch"),
            )
        )
        rings = stored(
            led.repartition("region", "stretch")
            .sortWithinPartitions("region", "stretch", F.desc("pivot"), "set_id")
            .mapInArrow(_divided(least, level), _REGION)
        )
        edges.append(
            rings.where("region IS NULL").select(F.col("set_id").alias("a"), F.col("n").alias("b"))
        )
        release(many)
        # names that belong together become one
        bridges = rings.where("region IS NULL AND linked IS NOT NULL")
        one = components(bridges.select(F.col("set_id").alias("a"), F.col("n").alias("b")))
        divided = (
            rings.where("region IS NOT NULL")
            .join(one.withColumnRenamed("id", "linked"), "linked", "left")
            .select("region", "set_id", "n", "shingles", F.coalesce("component", "linked").alias("linked"))
        )
        parts = stored(_sized(divided))
        if rows(parts) >= rows(large):
            # sets at middling distances from all pivots: windows only multiply them
            join(large)
            return edges
        regions, sizes = divided, parts
    return edges


def _perhaps(texts: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``texts`` whose ``__doc`` may be one of ``count`` ids (``first_doc``): all of those, few others."""
    bits = min(MOST_BITS, max(64, BITS_A_SET * count))

    def placed(df: DataFrame, column: str) -> DataFrame:
        place = F.pmod(F.xxhash64(column, F.lit(7)), F.lit(bits))
        return df.withColumn("__word", F.shiftright(place, 6)).withColumn("__at", (place % 64).cast("int"))

    words = placed(ids, "first_doc").groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __at)")).alias("__bits"))
    return (
        placed(texts, "__doc")
        .join(F.broadcast(words), "__word")
        .where("shiftright(__bits, __at) & 1 = 1")
        .select(*texts.columns)
    )


def _texts_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """text, set_id and region of the documents that are to give ``wanted`` sets.

    Where these are too many to be broadcast, what moves is hardly more than their texts.
    """
    texts = df.select(F.col("doc_id").alias("__doc"), filled().alias("text"))
    count = wanted.count()
    if count <= BROADCAST_SETS:
        wanted = F.broadcast(wanted)
    else:
        texts = _perhaps(texts, wanted, count)
    return texts.join(wanted, F.col("__doc").eqNullSafe(F.col("first_doc"))).select(
        "text", "set_id", "region"
    )


def jaccard_groups(df: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id of ``df`` (doc_id, text).

    Two documents link if 100 times the intersection of their shingle sets is at least
    ``least`` times the union; component_id is the smallest doc_id reachable by links.
    One row for each row. Texts are lower-cased in A-Z and read whole; one with fewer
    words than a shingle is one shingle; a null, empty or wordless text has none and
    links with nothing. Equal sets link, also of rows with equal or null doc_id; a
    component of null ids only has a null component_id. An empty table stays empty;
    more columns are left out. Shingles and sets are compared by 64-bit digests.
    """
    context = df.sparkSession.sparkContext
    given = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(LEAST_PARTS, (given["bytes"] or 0) // PART_BYTES + 1)
    common = context.broadcast(common_shingles(df.select("doc_id", "text"), words, given["rows"]))
    with batches_of(df.sparkSession, WIDE_ROWS):
        full = stored(
            df.select("doc_id", filled().alias("text")).mapInArrow(
                _sketched(words, least, common, parts), _SKETCH_DDL
            )
        )
        sketches = stored(full.where("part IS NULL").select("doc_id", "n_shingles", "set_id"))
        near = (
            full.where("part IS NOT NULL")
            .select("part", "size", "cells", "a", "b")
            .repartition("part")
            .sortWithinPartitions("part")
            .mapInArrow(_near, "a long, b long")
        )
        # all that a set has met is joined to the smallest of them; a set has met no more
        # others than it has cells
        met = near.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("bs"))
        near = stored(
            met.select(F.least("a", "m").alias("b"), F.explode(F.concat("bs", F.array("a"))).alias("a"))
            .where("a <> b")
            .distinct()
        )
    release(full)
    region_of = components(near).select(F.col("id").alias("short"), F.col("component").alias("region"))
    # rows of the document whose text gives a set: equal ones give it once
    holders = (
        sketches.where("set_id IS NOT NULL")
        .groupBy("set_id", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.coalesce(F.min_by("rows", "doc_id"), F.max("rows")).alias("rows"),
        )
    )
    holders = stored(holders)
    short = F.shiftrightunsigned("set_id", 64 - SHORT_BITS)
    wanted = stored(
        region_of.join(holders.withColumn("short", short), "short").select(
            "set_id", "region", "first_doc", "rows"
        )
    )
    with batches_of(df.sparkSession, WIDE_ROWS):
        given = [_texts_of(df, wanted.where("rows = 1")).mapInArrow(_sets(words), _REGION)]
        repeated = wanted.where("rows > 1")
        if not repeated.isEmpty():
            more = _texts_of(df, repeated).mapInArrow(_sets(words), _REGION)
            given.append(more.dropDuplicates(["set_id"]))
        regions = stored(reduce(DataFrame.unionByName, given))
        edges = _links(regions, least)
    all_edges = edges[0]
    for more in edges[1:]:
        all_edges = all_edges.unionByName(more)
    found = components(all_edges).withColumnRenamed("id", "set_id")
    of_set = holders.join(found, "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    names = of_set.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    of_set = of_set.join(names, "component").select("set_id", "component_id")
    return sketches.join(of_set, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by three-word shingles."""
    return jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
