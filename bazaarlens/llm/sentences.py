"""Substring dedup: repeated runs of sentences.

From every sentence on, and up to every sentence, the shortest run of at least two
sentences and ``LEAST_WORDS`` words is hashed. Equal runs are joined over the whole
corpus; of each, the first by doc_id and place stays, and sentences covered by any
other are removed. Because the length of a run depends on its own words only, a
repeated passage gives the same runs wherever it stands, up to its last sentence. A
sentence of ``PASSAGE`` words is a run by itself.

Passages that are glued to other words at their edges hold no whole run. In what is
left, every window of ``PASSAGE`` words that an earlier document holds too is cut out.
Windows are found by winnowing: of each, the smallest hash of ``GRAM`` words in it is
looked up first, which equal windows share, so only windows that can be repeated are
joined, and none that is repeated is missed.

Runs and hashes of words are shuffled once. Before that each task settles what it can: of
equal ones that it has pooled only the first goes on, so a very common one is a row for
each pool. What documents lose is sent back to them as ranges of sentences.

Texts move once: they are dealt by document when sentences are removed, and what is left
of them is stored in buckets by the same key, so the lists that later steps make go to the
texts. A document stays where it was dealt, whatever its text has become.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from bazaarlens.llm.common import append_columns, filled, sliced, table, without
from bazaarlens.operators.scratch import stored, stored_by

LEAST_SENTENCES, LEAST_WORDS = 2, 20
#: Words of a passage that is repeated whatever sentences it lies in, and of the groups it is found by.
PASSAGE, GRAM = 50, 20
#: Documents' lists are looked up by broadcast up to so many entries, by a shuffled join beyond.
BROADCAST_ENTRIES = 1_000_000

_ENDS = re.compile(r"(?<=[.!?])\s+|\n+").finditer
_WORDS = re.compile(r"\w+").findall
# a run's code: the first sentence, the number of sentences
_LENGTH = 1 << 8
#: Runs or hashes that a task compares with each other before they are shuffled.
POOL = 200_000
# a range's code: the first sentence, the one after the last
_SPAN = 1 << 31


def split(text: str) -> tuple[list[int], list[int]]:
    """Where sentences end (what follows an end belongs to the sentence) and their words.

    Sentences end at ., ! or ? before white space, and at line ends. One without
    letters or digits belongs to the sentence before it.
    """
    ends, words = [], []
    start = 0
    for cut in [*(m.end() for m in _ENDS(text)), len(text)]:
        if cut <= start:
            continue
        n = len(_WORDS(text, start, cut))
        if n == 0 and ends:
            ends[-1] = cut
        else:
            ends.append(cut)
            words.append(n)
        start = cut
    return ends, words


def runs_of(words: list[int]) -> list[tuple[int, int]]:
    """First sentence and number of sentences of each run, without repeats."""
    n = len(words)
    total = [0]
    for w in words:
        total.append(total[-1] + w)
    found = []
    j = 0
    for i in range(n):
        j = max(j, i + LEAST_SENTENCES)
        while j <= n and total[j] - total[i] < LEAST_WORDS:
            j += 1
        if j > n:
            break
        found.append((i, j - i))
    known = set(found)
    i = 0
    for j in range(LEAST_SENTENCES, n + 1):
        while i + 1 <= j - LEAST_SENTENCES and total[j] - total[i + 1] >= LEAST_WORDS:
            i += 1
        if total[j] - total[i] >= LEAST_WORDS and (i, j - i) not in known:
            found.append((i, j - i))
    found += [(i, 1) for i, w in enumerate(words) if w >= PASSAGE]
    return [(i, size) for i, size in found if size < _LENGTH]


def _firsts(columns: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Which rows equal the first of their group in all columns; ``starts``: of groups."""
    sizes = np.diff(starts, append=len(columns[0]))
    return np.logical_and.reduce([c == np.repeat(c[starts], sizes) for c in columns])


def _groups(key: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of every text; those known to be repeated carry no hash any more."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    hashes, ids, marks, codes, again = [], [], [], [], []

    def pooled() -> pa.RecordBatch:
        # a run's first place goes on, later ones are settled
        run = np.array(hashes, np.uint64)
        place = [np.array(x, np.int64) for x in (ids, marks, codes)]
        known = np.array(again, bool)
        order = np.lexsort((*place[::-1], run))
        order = np.concatenate([order[~known[order]], order[known[order]]])
        run, place, known = run[order], [x[order] for x in place], known[order]
        n = int((~known).sum())
        starts = _groups(run[:n])
        settled = np.r_[~_firsts([x[:n] for x in place], starts), np.ones(len(run) - n, bool)]
        kept = settled.copy()
        kept[starts] = True  # the first rows, once
        for x in (hashes, ids, marks, codes, again):
            x.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(run.view(np.int64)[kept], mask=settled[kept]), *[pa.array(x[kept]) for x in place]],
            names=["run", "id", "mark", "code"],
        )

    for batch in sliced(batches):
        for doc_id, mark, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            ends, words = split(text)
            starts = [0, *ends]
            coded = [
                digest(" ".join(_WORDS(text[a:b].lower()))).to_bytes(8, "little")
                for a, b in zip(starts, ends)
            ]
            seen = set()
            for i, size in sorted(runs_of(words)):
                run = digest(b"".join(coded[i : i + size]))
                # a repeat within the text is no first one
                again.append(run in seen)
                seen.add(run)
                hashes.append(run)
                ids.append(doc_id)
                marks.append(mark)
                codes.append(i * _LENGTH + size)
            if len(hashes) >= POOL:
                yield pooled()
    if hashes:
        yield pooled()


def _later(names: list[str], same: int):
    """Places of all rows but those of the first; rows are sorted by their hash and place.

    ``names``: the hash and the columns of a place, of which the first ``same`` tell whether
    a row is like the first of its hash. Rows without a hash are known to be later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            settled = batch.column(names[0]).is_null().to_numpy(zero_copy_only=False)
            place = [batch.column(c).to_numpy() for c in names[1:]]
            later = settled.copy()
            key = batch.column(names[0]).drop_null().to_numpy()
            if len(key):
                at = np.flatnonzero(~settled)
                own = [x[at] for x in place[:same]]
                again = key[0] == last_key  # the first one was in the batch before
                if again:
                    key, own = np.r_[key[:1], key], [np.r_[x, y] for x, y in zip(last, own, strict=True)]
                starts = _groups(key)
                later[at] = ~_firsts(own, starts)[int(again) :]
                last_key, last = key[-1], [x[starts[-1] : starts[-1] + 1] for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(x[later]) for x in place], names=names[1:])

    return run


def _others(found: DataFrame, names: list[str], same: int) -> DataFrame:
    """Places (all columns but the hash) of what is not the first of its hash; one shuffle."""
    key, *place = names
    return (
        # settled rows are dealt evenly
        found.repartition(F.coalesce(key, F.xxhash64(*place)))
        .sortWithinPartitions(*names)
        .mapInArrow(_later(names, same), ", ".join(f"{c} long" for c in place))
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences that documents lose, as few ranges: first sentence and the one after."""
    for batch in sliced(batches):
        lists = []
        for codes in batch.column("list"):
            code = np.sort(codes.values.to_numpy())
            first, ends = code // _LENGTH, np.maximum.accumulate(code // _LENGTH + code % _LENGTH)
            new = np.flatnonzero(np.r_[True, first[1:] > ends[:-1]])
            lists.append(first[new] * _SPAN + ends[np.r_[new[1:] - 1, len(code) - 1]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("mark"), pa.array(lists, pa.list_(pa.int64()))],
            names=["id", "mark", "list"],
        )


def _id() -> Column:
    """doc_id, the smallest number where it is null."""
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))


def _mark() -> Column:
    """Hash of the text: rows of one doc_id with other texts are other documents."""
    return F.xxhash64(filled())


def repeated_sentences(df: DataFrame) -> DataFrame:
    """Sentences to remove: id, mark, and a list of ranges of sentences."""
    runs = df.select(_id().alias("id"), _mark().alias("mark"), filled().alias("text")).mapInArrow(
        _runs, "run long, id long, mark long, code long"
    )
    later = _others(runs, ["run", "id", "mark", "code"], 3)
    lost = later.groupBy("id", "mark").agg(F.collect_set("code").alias("list"))
    return lost.mapInArrow(_ranges, "id long, mark long, list array<long>")


_FIELDS = [
    StructField("text", StringType()),
    StructField("n_sentences", LongType()),
    StructField("n_removed", LongType()),
]


def _cut(text: str, ranges: list[int] | None) -> tuple[str, int, int]:
    ends, _ = split(text)
    if not ranges:
        return text, len(ends), 0
    starts, kept, at, lost = [0, *ends], [], 0, 0
    for first, end in (divmod(r, _SPAN) for r in sorted(ranges)):
        kept.append(text[starts[at] : starts[first]])
        at, lost = end, lost + end - first
    return "".join(kept) + text[starts[at] :], len(ends), lost


#: Columns of dealt documents: id and hash of the text they are dealt by, hash of the text they have.
_DEALT = ["__id", "__mark", "__told"]


def drop_repeated_sentences(df: DataFrame, *, dealt: bool = False) -> DataFrame:
    """``df`` (doc_id, text, ...) without repeated sentence runs; adds n_sentences, n_removed.

    One row for each row. Rows equal in doc_id and text are one document and keep the
    same sentences; rows of one doc_id with other texts are other documents. Of equal
    runs the one with the smallest doc_id stays, a null one first, then the earliest
    in the text. A null text becomes empty; a text whose sentences are all repeated
    becomes empty; an empty table stays empty; columns of the new names are replaced.
    Documents are told apart by all 64 bits of the text's hash.

    ``dealt``: the rows lie by document, in as many partitions as a shuffle makes, and have
    the columns that ``drop_repeated_passages`` finds them by.
    """
    kept = without(df, ["text", "n_sentences", "n_removed"])
    given = df.select(
        *[F.col(f"`{c}`") for c in kept], filled().alias("__text"), _id().alias("__id"), _mark().alias("__mark")
    )
    removed = repeated_sentences(df)
    if dealt:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        given = given.repartition(partitions, "__id", "__mark")
        removed = removed.hint("shuffle_hash")
        kept += _DEALT[:2]
    else:
        removed = _held(removed)
    joined = given.join(
        removed, (F.col("__id") == F.col("id")) & (F.col("__mark") == F.col("mark")), "left"
    )

    def make() -> Callable[[list, list], list]:
        return lambda texts, lists: (
            [list(x) for x in zip(*map(_cut, texts, lists))] if texts else [[], [], []]
        )

    cut = append_columns(joined, [F.col("__text"), F.col("list")], _FIELDS, make, kept)
    return cut.withColumn("__told", _mark()) if dealt else cut


def _hashed(coded: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n successive words, from the words' hashes."""
    out = np.zeros(max(0, len(coded) - n + 1), np.uint64)
    factor = 1
    for i in range(n):
        out += coded[i : i + len(out)] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    return out ^ (out >> np.uint64(29))


def _least(grams: np.ndarray) -> np.ndarray:
    """The smallest hash of ``GRAM`` words inside each window of ``PASSAGE`` words."""
    width, done = PASSAGE - GRAM + 1, 1
    least = grams
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least


class _Coder(dict):
    """Hashes of words, remembered up to a fixed number."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        words = _WORDS(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: A hash that no other document of its pool has; one that some have, which goes on
#: with the first of these; the others, of which it is known already.
_ALONE, _SHARED, _SETTLED = 0, 1, 2


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest hash of each window of each text, once a text, and what its pool tells."""
    coder = _Coder()
    held: list[list[np.ndarray]] = []

    def pooled() -> pa.RecordBatch:
        gram, ids, marks = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((marks, ids, gram))
        gram, ids, marks = gram[order], ids[order], marks[order]
        starts = _groups(gram)
        sizes = np.diff(starts, append=len(gram))
        first = _firsts([ids, marks], starts)
        several = ~np.logical_and.reduceat(first, starts) if len(starts) else np.zeros(0, bool)
        kind = np.where(first, np.repeat(np.where(several, _SHARED, _ALONE), sizes), _SETTLED)
        return pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(ids), pa.array(marks), pa.array(kind.astype(np.int8))],
            names=["gram", "id", "mark", "kind"],
        )

    size = 0
    for batch in sliced(batches):
        found = [
            np.unique(_least(_hashed(codes, GRAM))) if len(codes) >= PASSAGE else np.zeros(0, np.uint64)
            for codes in map(coder.of, batch.column(2).to_pylist())
        ]
        sizes = list(map(len, found))
        ids, marks = (np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1))
        held.append([np.concatenate([np.zeros(0, np.uint64), *found]), ids, marks])
        size += len(ids)
        if size >= POOL:
            yield pooled()
            size = 0
    if held:
        yield pooled()


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and their hashes that other documents have too; rows are sorted by hash.

    A hash has few rows that are not settled: one for each pool that it was in.
    """
    names = ["gram", "id", "mark", "kind"]

    def judged(columns: list[np.ndarray]) -> pa.RecordBatch:
        gram, ids, marks, kind = columns
        starts = _groups(gram)
        alone = _firsts([ids, marks], starts) & (kind == _ALONE)
        shared = ~np.logical_and.reduceat(alone, starts) if len(starts) else np.zeros(0, bool)
        kept = np.repeat(shared, np.diff(starts, append=len(gram)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[kept]), pa.array(marks[kept]), pa.array(gram[kept])], names=["id", "mark", "gram"]
        )

    carried = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names]
        settled = columns[3] == _SETTLED
        if settled.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[i][settled]) for i in (1, 2, 0)], names=["id", "mark", "gram"]
            )
            columns = [c[~settled] for c in columns]
        if carried is not None:
            columns = [np.r_[x, y] for x, y in zip(carried, columns, strict=True)]
        cut = int(_groups(columns[0])[-1]) if len(columns[0]) else 0
        if cut:
            yield judged([c[:cut] for c in columns])
        carried = [c[cut:] for c in columns]
    if carried is not None:
        yield judged(carried)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and first word of each window whose smallest hash is among the given ones.

    Of a window that several documents of a pool have, only the first document's go on
    with a hash; the others' are known to be later.
    """
    coder = _Coder()
    held: list[list[np.ndarray]] = []
    size = 0

    def pooled() -> pa.RecordBatch:
        window, *place = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((*place[::-1], window))
        window, place = window[order], [x[order] for x in place]
        settled = ~_firsts(place[:2], _groups(window))
        return pa.RecordBatch.from_arrays(
            [pa.array(window.view(np.int64), mask=settled), *map(pa.array, place)],
            names=["window", "id", "mark", "place"],
        )

    for batch in sliced(batches, 64):
        for doc_id, mark, text, grams in zip(
            *[batch.column(i).to_pylist() for i in range(3)], batch.column(3), strict=True
        ):
            codes = coder.of(text)
            wanted = grams.values.to_numpy().view(np.uint64)
            at = np.flatnonzero(np.isin(_least(_hashed(codes, GRAM)), wanted))
            held.append([_hashed(codes, PASSAGE)[at], np.full(len(at), doc_id), np.full(len(at), mark), at])
            size += len(at)
        if size >= POOL:
            yield pooled()
            size = 0
    if held:
        yield pooled()


def _held(lists: DataFrame) -> DataFrame:
    """Lists of documents (id, mark, list), stored; broadcast if they have few entries.

    Beyond that each task hashes its share of them: texts are not sorted for a join.
    """
    rows = stored(lists)
    entries = rows.agg(F.sum(F.size("list"))).first()[0] or 0
    return F.broadcast(rows) if entries <= BROADCAST_ENTRIES else rows.hint("shuffle_hash")


def _listed(rows: DataFrame, value: str, places: DataFrame | None) -> DataFrame:
    """Values of each document (id, mark) as a list; ``places``: what they are dealt by, if not by that."""
    lists = rows.groupBy("id", "mark").agg(F.collect_set(value).alias("list"))
    if places is not None:
        lists = (
            lists.join(places, ["id", "mark"])
            .groupBy("id", F.col("place").alias("mark"))
            .agg(F.flatten(F.collect_list("list")).alias("list"))
        )
    return _held(lists)


def _without_passages(text: str, places: list[int] | None) -> tuple[str, int]:
    if not places:
        return text, 0
    starts = [m.start() for m in re.finditer(r"\w+", text)]
    gone = np.zeros(len(starts), bool)
    for place in places:
        gone[place : place + PASSAGE] = True
    # a word goes with what follows it
    edges = [*starts, len(text)]
    kept = "".join(text[edges[i] : edges[i + 1]] for i in np.flatnonzero(~gone))
    return text[: starts[0]] + kept, int(gone.sum())


def drop_repeated_passages(df: DataFrame, *, dealt: bool = False) -> DataFrame:
    """``df`` (doc_id, text, ...) without passages that an earlier document holds; adds n_cut.

    A passage is ``PASSAGE`` successive words, lower-cased, wherever sentences begin or
    end. It stays in the document with the smallest doc_id, a null one first; n_cut
    counts the words removed. Documents are told apart as in ``drop_repeated_sentences``,
    by all 64 bits of the text's hash; repeats within one document stay.

    ``dealt``: ``df`` has the columns by which ``drop_repeated_sentences`` dealt it. Stored
    in buckets of the first two, its texts do not move.
    """
    kept = without(df, ["text", "n_cut", *(_DEALT if dealt else [])])
    columns = [F.col(f"`{c}`") for c in kept]
    names = [F.col(c) for c in _DEALT] if dealt else [_id(), _mark(), _mark()]
    place = [c.alias(name) for c, name in zip(names, _DEALT)]
    given = df.select(*columns, filled().alias("__text"), *place)
    texts = df.select(names[0].alias("id"), names[2].alias("mark"), filled().alias("text"))
    places = None
    if dealt:  # rows of one doc_id whose texts have become equal are one document in two places
        places = df.select(
            F.col("__id").alias("id"), F.col("__told").alias("mark"), F.col("__mark").alias("place")
        ).distinct()

    def joined(lists: DataFrame, how: str) -> DataFrame:
        here = (F.col("__id") == F.col("id")) & (F.col("__mark") == F.col("mark"))
        return given.join(lists, here, how)

    grams = texts.mapInArrow(_grams, "gram long, id long, mark long, kind byte")
    settled = F.col("kind") == _SETTLED
    spread = F.when(settled, F.xxhash64("id", "mark", "gram")).otherwise(F.col("gram"))
    shared = (
        grams.repartition(spread)
        .sortWithinPartitions("gram", "id", "mark")
        .mapInArrow(_wanted, "id long, mark long, gram long")
    )
    wanted = _listed(shared, "gram", places)
    windows = (
        joined(wanted, "inner")  # a repeated row adds nothing new
        .select("__id", "__told", "__text", "list")
        .mapInArrow(_windows, "window long, id long, mark long, place long")
    )
    later = _others(windows, ["window", "id", "mark", "place"], 2)
    cut = joined(_listed(later.withColumnRenamed("place", "word"), "word", places), "left")

    def make() -> Callable[[list, list], list]:
        return lambda texts, lists: (
            [list(x) for x in zip(*map(_without_passages, texts, lists))] if texts else [[], []]
        )

    fields = [StructField("text", StringType()), StructField("n_cut", LongType())]
    return append_columns(cut, [F.col("__text"), F.col("list")], fields, make, kept)


def op5_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated sentence runs and without repeated passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = stored_by(drop_repeated_sentences(docs, dealt=True), *_DEALT[:2])
    return drop_repeated_passages(left, dealt=True).select(
        "doc_id", "text", "n_sentences", "n_removed", "n_cut"
    )
