"""Toxicity by class-conditional Kneser-Ney models of how words are spelt.

Two models, toxic and ordinary, give every word of a document a log-likelihood from
its letters, five at a time, word ends included. Their highest order is counted in
the labelled documents of the class. All lower orders are shared: continuation counts
over the words of the whole corpus, so that an expression too rare for either class
is judged by the same backoff in both. A document is described by the difference of
the two log-likelihoods per letter, over the whole text and over its most telling
words, and a logistic calibration turns these into a score.

Differences of the most frequent letter groups, ``HELD_GROUPS`` at most, are sent to the
workers. Words with any other group are looked up by joins, so every group keeps its own
value at every size. Groups and texts are told apart by 64-bit digests, values are whole
multiples of 1 / ``_VALUE``, so sums do not depend on the way or order. Word and
letter-group counts stay distributed.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from bazaarlens.llm.common import append_columns, filled, sliced, table, without
from bazaarlens.operators.scratch import stored

ORDER = 5
DISCOUNT = 0.75
#: Letter groups whose values are broadcast (a digest and a number each); others are joined.
HELD_GROUPS = 1 << 20
_VALUE = float(1 << 20)
#: Sums of words that are joined are broadcast up to so many texts, shuffled beyond.
BROADCAST_TEXTS = 200_000
#: Labels are looked up by broadcast up to so many rows, by a shuffled join beyond.
BROADCAST_LABELS = 2_000_000
THRESHOLD = 0.3
_WORDS = re.compile(r"[^\W_]+").findall
#: Words a task holds before it passes their counts on; letters of words before it forgets them.
_HELD, _LETTERS = 120_000, 3_000_000
#: Different words, text by text, that are looked up at once.
_AT_ONCE = 100_000
_START, _END = "\x02", "\x03"


@dataclass(frozen=True)
class Model:
    """Differences of log-likelihood of the held letter groups, and the calibration's weights.

    ``keys``: sorted digests of the groups; ``rest``: text and value of all other groups,
    None if there are none.
    """

    keys: np.ndarray
    differences: np.ndarray
    rest: DataFrame | None
    weights: tuple[float, ...]


def _fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is never looked at."""
    return F.coalesce(_fold(doc_id) == 2, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, kind): 0 no usable label, 1 ordinary, 2 toxic; 3 and 4 likewise for calibration rows."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out())
        .select(
            "doc_id",
            (F.when(F.col("toxic") > 0, 2).otherwise(1) + F.when(_fold() == 3, 2).otherwise(0)).alias("kind"),
        )
    )
    known = stored(known)
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return docs.select("doc_id", filled().alias("text")).join(known, "doc_id", "left").select(
        "text", F.coalesce("kind", F.lit(0)).alias("kind")
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word, in all and by kind, summed up within the task."""
    counts: list[Counter] = [Counter() for _ in range(5)]

    def flushed() -> pa.RecordBatch:
        words = list(counts[0])
        batch = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string())]
            + [pa.array([c[w] for w in words], pa.int64()) for c in counts],
            names=["word", "n", "n1", "n2", "n3", "n4"],
        )
        for c in counts:
            c.clear()
        return batch

    for batch in sliced(batches):
        texts, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for text, kind in zip(texts, kinds, strict=True):
            words = set(_WORDS(text.lower()))
            counts[0].update(words)
            if kind:
                counts[kind].update(words)
            if len(counts[0]) >= _HELD:
                yield flushed()
    yield flushed()


def _spelt(words: DataFrame) -> DataFrame:
    """Groups of ``ORDER`` letters with their counts."""
    padded = F.concat(F.lit(_START * (ORDER - 1)), "word", F.lit(_END))
    groups = F.transform(
        F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(padded, i, F.lit(ORDER))
    )
    return (
        words.select(F.explode(groups).alias("gram"), "n", "n1", "n2", "n3", "n4")
        .groupBy("gram")
        .agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3", "n4")])
    )


def _smoothed(grams: DataFrame) -> DataFrame:
    """Log-likelihoods of each group: toxic and ordinary, without and with calibration rows."""
    # continuation counts, from the shared groups of each order to the next lower one
    lower: list[DataFrame] = []
    level = grams.select("gram")
    for order in range(ORDER - 1, 0, -1):
        level = (
            level.groupBy(F.substring("gram", 2, order).alias("gram"))
            .agg(F.count(F.lit(1)).alias("k"))
        )
        level = stored(level)
        lower.append(level)
    backoff = None
    for order in range(1, ORDER):
        counts = lower[ORDER - 1 - order]
        context = F.substring("gram", 1, order - 1)
        beside = Window.partitionBy("context")
        known = counts.withColumn("context", context).select(
            "gram",
            F.substring("gram", 2, order).alias("rest"),
            "k",
            F.sum("k").over(beside).alias("all"),
            F.count(F.lit(1)).over(beside).alias("types"),
        )
        if backoff is None:
            below = known.withColumn("below", F.lit(1.0 / 256))
        else:
            below = known.join(backoff.withColumnsRenamed({"gram": "rest", "p": "below"}), "rest")
        backoff = below.select(
            "gram",
            (
                (F.greatest(F.col("k") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("types") * F.col("below"))
                / F.col("all")
            ).alias("p"),
        )
        backoff = stored(backoff)
    beside = Window.partitionBy(F.substring("gram", 1, ORDER - 1))
    first = {"t0": F.col("n2"), "o0": F.col("n1"), "t1": F.col("n2") + F.col("n4"),
             "o1": F.col("n1") + F.col("n3")}
    seen = grams.select(
        "gram",
        F.substring("gram", 2, ORDER - 1).alias("rest"),
        "n",
        *[c.alias(k) for k, c in first.items()],
    )
    seen = seen.select(
        "*",
        *[F.sum(k).over(beside).alias(f"{k}_all") for k in first],
        *[F.sum((F.col(k) > 0).cast("long")).over(beside).alias(f"{k}_types") for k in first],
    )

    def likelihood(k: str) -> Column:
        rest = DISCOUNT * F.col(f"{k}_types") * F.col("p")
        p = (F.greatest(F.col(k) - DISCOUNT, F.lit(0.0)) + rest) / F.col(f"{k}_all")
        return F.log(F.when(F.col(f"{k}_all") > 0, p).otherwise(F.col("p"))).alias(k)

    return seen.join(backoff.withColumnRenamed("gram", "rest"), "rest").select(
        "gram", "n", *[likelihood(k) for k in first]
    )


def _values(likely: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """Digests and differences, twice, of the held groups; the other groups as a table."""
    whole = [F.round((F.col(f"t{i}") - F.col(f"o{i}")) * _VALUE).cast("int").alias(f"v{i}") for i in (0, 1)]
    level = F.length(F.bin("n")).alias("level")
    rows = stored(likely.select("gram", *whole, level))
    # whole levels of frequency, from the top, as far as they fit
    held, least = 0, 65
    for found, count in sorted(map(tuple, rows.groupBy("level").count().collect()), reverse=True):
        held += count
        if held > HELD_GROUPS:
            break
        least = found
    taken = rows.where(F.col("level") >= least).select("gram", "v0", "v1").toArrow()
    keys = _digests(taken.column("gram").to_pylist())
    order = np.argsort(keys)
    values = np.stack([taken.column(f"v{i}").to_numpy()[order] for i in (0, 1)])
    return keys[order], values, rows.where(F.col("level") < least) if held > HELD_GROUPS else None


_FEATURES = [StructField(f"__f{i}", DoubleType()) for i in range(5)]
#: Odd multipliers of the letters of a group.
_MIX = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 | 1 for i in range(ORDER)], np.uint64)


def _windows(text: str) -> np.ndarray:
    """64-bit digests of the ``ORDER`` letters that start at each place of a text."""
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    places = max(len(letters) - ORDER + 1, 0)
    mixed = np.zeros(places, np.uint64)
    for i in range(ORDER):
        mixed = (mixed ^ (mixed >> np.uint64(29))) + letters[i : i + places] * _MIX[i]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _digests(groups: list[str]) -> np.ndarray:
    """Digests of groups of exactly ``ORDER`` letters."""
    return _windows("".join(groups))[::ORDER]


def _speller(keys: np.ndarray, values: np.ndarray) -> Callable[[list[str]], tuple[list[int], dict]]:
    """A function from words to the sums of their held groups, and the others of words with some.

    The groups of all words are looked up together: first by the digest's leading bits,
    then by comparing the few keys that share them.
    """
    bits = max(len(keys).bit_length(), 1)
    shift, last = np.uint64(64 - bits), max(len(keys) - 1, 0)
    starts = np.searchsorted(keys >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
    steps = int(np.diff(starts).max())

    def spell(words: list[str]) -> tuple[list[int], dict[str, list[str]]]:
        if not words:
            return [], {}
        text = "".join([_START * (ORDER - 1) + word + _END for word in words])
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1  # groups of a word
        # a padded word has ORDER - 1 places more than groups
        at = np.arange(sizes.sum()) + np.repeat(np.arange(len(words)) * (ORDER - 1), sizes)
        digests = _windows(text)[at]
        place = starts[(digests >> shift).astype(np.int64)]
        value, known, left = np.zeros(len(at), np.int64), np.zeros(len(at), bool), np.arange(len(at))
        for step in range(steps):
            here = np.minimum(place[left] + step, last)
            hit = keys[here] == digests[left]
            value[left[hit]], known[left[hit]] = values[here[hit]], True
            left = left[keys[here] < digests[left]]
        sums = np.add.reduceat(value, np.cumsum(sizes) - sizes).tolist()
        of, missing = np.repeat(np.arange(len(words)), sizes), defaultdict(list)
        for i in np.flatnonzero(~known).tolist():
            missing[words[of[i]]].append(text[at[i] : at[i] + ORDER])
        return sums, missing

    return spell


class _Memory(dict):
    """The sums of words that were met, up to a fixed number of letters."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, partial: bool):
        self.spell, self.partial, self.size = _speller(keys, values), partial, 0
        #: Groups not held of words that have some, where these are looked up elsewhere.
        self.missing: dict[str, list[str]] = {}

    def learn(self, counts: list[Counter]) -> None:
        """Look up the words of texts that are not known yet, all at once."""
        if self.size >= _LETTERS:
            self.clear()
            self.missing.clear()
            self.size = 0
        new = list({word for words in counts for word in words if word not in self})
        sums, missing = self.spell(new)
        self.update(zip(new, sums, strict=True))
        self.size += sum(map(len, new))
        if self.partial:
            self.missing.update(missing)


def _counted(texts: list[str]) -> Iterator[list[Counter]]:
    """The words of texts with their numbers, for so many texts at once as are short."""
    held: list[Counter] = []
    size = 0
    for text in texts:
        held.append(Counter(_WORDS(text.lower())))
        size += len(held[-1])
        if size >= _AT_ONCE:
            yield held
            held, size = [], 0
    yield held


def _describe(words: Counter, of: _Memory, more: dict | None = None) -> list[float]:
    """Length-normalised differences of a text with these words.

    ``more``: sums of those words that have groups which are not held.
    """
    if not words:
        return [0.0] * 5
    total, letters, ratio, best = 0, 0, float("-inf"), []
    if more is not None:
        total, ratio, best = more["total"], more["ratio"], list(more["best"])
    for word, n in words.items():
        size = len(word) + 1
        letters += n * size
        if word not in of.missing:
            worth = of[word]
            total += n * worth
            if worth > ratio * size:
                ratio = worth / size
            best.append(worth)
    # most telling of the different words: their sum per letter, bounded
    three = [*nlargest(3, best), 0, 0, 0][:3]
    return [x / _VALUE for x in (total / letters, ratio, *three)]


def _more(df: DataFrame, keys: np.ndarray, values: np.ndarray, rest: DataFrame) -> DataFrame:
    """Of each text with words that have groups not held: its digest, and these words' sums."""
    shared = df.sparkSession.sparkContext.broadcast((keys, values))

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(*shared.value, True)
        for batch in sliced(batches):
            digests = iter(batch.column(0).to_pylist())
            for counts in _counted(batch.column(1).to_pylist()):
                memory.learn(counts)
                rows = [
                    (digest, word, n, memory[word], memory.missing[word])
                    for words, digest in zip(counts, digests, strict=False)
                    for word, n in words.items()
                    if word in memory.missing
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["__digest", "word", "n", "held", "groups"],
                )

    found = stored(
        df.select(F.xxhash64(filled()).alias("__digest"), filled().alias("text"))
        .mapInArrow(emitted, "__digest long, word string, n long, held long, groups array<string>")
        .dropDuplicates(["__digest", "word"])
    )
    spelt = found.dropDuplicates(["word"]).select("word", "held", F.explode("groups").alias("gram"))
    worth = stored(
        spelt.join(rest, "gram", "left")
        .groupBy("word")
        .agg((F.max("held") + F.sum(F.coalesce("value", F.lit(0)))).alias("worth"))
    )
    sums = stored(
        found.join(worth, "word")
        .groupBy("__digest")
        .agg(
            F.struct(
                F.sum(F.col("n") * F.col("worth")).alias("total"),
                F.max(F.col("worth") / (F.length("word") + 1)).alias("ratio"),
                F.slice(F.sort_array(F.collect_list("worth"), asc=False), 1, 3).alias("best"),
            ).alias("__more")
        )
    )
    return F.broadcast(sums) if sums.count() <= BROADCAST_TEXTS else sums


def _features(
    df: DataFrame,
    keys: np.ndarray,
    values: np.ndarray,
    rest: DataFrame | None,
    keep: list[str],
    fields: list[StructField] = _FEATURES,
    judge: Callable[[np.ndarray], list[list]] | None = None,
) -> DataFrame:
    """``df`` with features; ``rest``: letter groups and values that are not held.

    ``judge`` turns the features of rows into the values of ``fields``, in the same worker:
    a second pass would keep a second worker beside each task's first.
    """
    shared = df.sparkSession.sparkContext.broadcast((keys, values))
    partial, inputs = rest is not None, ["text"]
    if partial:
        more = _more(df, keys, values, rest)
        df = df.withColumn("__digest", F.xxhash64(filled())).join(more, "__digest", "left")
        inputs.append(F.col("__more"))

    def make() -> Callable[..., list]:
        memory = _Memory(*shared.value, partial)

        def work(texts: list, added: list | None = None) -> list:
            rows, given = [], iter(added or [None] * len(texts))
            for counts in _counted([text or "" for text in texts]):
                memory.learn(counts)
                rows += [_describe(words, memory, more) for words, more in zip(counts, given, strict=False)]
            if judge:
                return judge(np.array(rows, float).reshape(len(rows), len(_FEATURES)))
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 5

        return work

    return append_columns(df, inputs, fields, make, keep)


def _scaled(features: np.ndarray) -> np.ndarray:
    """Bounded features, so that no single one decides without limit."""
    scale = np.array([20.0, 2.0, 0.5, 0.5, 0.5])
    return np.clip(features * scale, -6.0, 6.0)


#: Sums over rows are of whole multiples of 1 / _UNIT, so that they do not depend on order.
_UNIT = float(1 << 32)


def _slopes(rows: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log-likelihood at ``w``, over all rows."""
    width = len(w)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + width * width, np.int64)
        for batch in batches:
            toxic = batch.column(0).to_numpy() == 4
            features = np.column_stack([batch.column(i).to_numpy() for i in range(1, width)])
            x = np.hstack([np.ones((len(features), 1)), _scaled(features)])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            first = x * (toxic - p)[:, None]
            second = (x[:, :, None] * x[:, None, :] * (p * (1 - p))[:, None, None]).reshape(len(x), -1)
            total += np.rint(np.hstack([first, second]) * _UNIT).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["sums"])

    # one row of fixed size from each task
    parts = [row["sums"] for row in rows.mapInArrow(summed, "sums array<long>").collect()]
    sums = np.array([sum(column) / _UNIT for column in zip(*parts, strict=True)])
    return sums[:width], sums[width:].reshape(width, width)


def _calibrated(rows: DataFrame) -> tuple[float, ...]:
    """Logistic regression by Newton's method over all rows, slightly pulled to zero.

    ``rows``: kind (3 ordinary, 4 toxic) and features, stored. No row is left out, so
    the share of toxic rows is that of the labels at every size.
    """
    width = len(_FEATURES) + 1
    if rows.select("kind").distinct().count() < 2:
        return (-3.0,) + (0.0,) * (width - 1)
    pull = np.full(width, 0.1)
    w = np.zeros(width)
    for _ in range(30):
        slope, bend = _slopes(rows, w)
        step = np.linalg.solve(bend + np.diag(pull), slope - pull * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Models and calibration from all texts and the labels that may be used.

    ``docs``: doc_id, text; ``labels``: doc_id, toxic. A document with several labels
    is toxic if one says so, null labels are none. Without labels of both classes the
    models agree and every score is the same.
    """
    given = _labelled(docs, labels)
    words = given.mapInArrow(
        _count_words, "word string, n long, n1 long, n2 long, n3 long, n4 long"
    )
    words = words.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3", "n4")])
    grams = stored(_spelt(words))
    keys, differences, others = _values(_smoothed(grams))
    rest = [None if others is None else others.select("gram", F.col(f"v{i}").alias("value")) for i in (0, 1)]
    # calibration on rows that the first pair of models has not counted
    described = stored(_features(given.where("kind >= 3"), keys, differences[0], rest[0], ["kind"]))
    return Model(keys, differences[1], rest[1], _calibrated(described))


def score(df: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` of its ``text``.

    One row for each row, repeated ones included. A null, empty or wordless text gets
    the score of a document without evidence; texts are read whole; an empty table
    stays empty; columns of these names are replaced.
    """
    kept = without(df.select(*keep) if keep is not None else df, ["score", "predicted"])
    names = [f"`{c}`" for c in kept]
    weights = np.array(model.weights)

    def judge(features: np.ndarray) -> list[list]:
        p = 1 / (1 + np.exp(-np.clip(weights[0] + _scaled(features) @ weights[1:], -30, 30)))
        return [p.tolist(), (p >= THRESHOLD).astype(int).tolist()]

    fields = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    return _features(df, model.keys, model.differences, model.rest, names, fields, judge)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
