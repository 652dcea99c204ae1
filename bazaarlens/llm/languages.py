"""Language identification by compression.

Each language has a raw-content dictionary for zstandard: passages of a bounded sample of
its labelled texts. A text is compressed with every language's dictionary, and the language
that leaves the fewest bytes wins. Texts go block by block, so that a long text's own words
don't replace the dictionary as what its matches are found in. A short text follows a run
of line ends: without it zstandard would store the few bytes as they are, at the same size
for every language. Case is folded on both sides, as dictionaries hold few upper-case words.

Equal sizes go to the language with more labelled texts. Where the margin over the second
language is narrow, the prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from bazaarlens.llm.common import append_columns, table

#: Texts sampled for a language, and characters of the passage that each gives.
SAMPLED, PASSAGE = 240, 500
#: Bytes of a text that are compressed at once.
BLOCK = 4096
#: Texts of fewer bytes are compressed after ``_CARRIER``.
SHORT = 300
#: Bytes that the second language must need more, and their share of the text's size;
#: the larger bound counts.
MARGIN, MARGIN_SHARE = 2, 0.005
#: Sampled rows are looked up by broadcast up to so many, by a shuffled join beyond.
BROADCAST_ROWS = 1_000_000
UNKNOWN = "und"
_SALTS = 256
_CARRIER = b"\n" * 64
_LEVEL, _SHORT_LEVEL, _LEAST_MATCH = 9, 12, 3
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """Languages, the most frequent first, and their dictionaries."""

    languages: list[str]
    dictionaries: list[bytes]


def held_out(column: str = "doc_id"):
    """Whether a document is kept for testing; one without id is not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """Dictionaries from all rows of ``docs`` (doc_id, text, lang) with a text and a language.

    A language's sample is the ``SAMPLED`` rows with the least digests, so it does not
    depend on the order of rows; repeated rows count once. A sampled text gives one passage
    from a place that its digest draws. Without labelled texts there is no language.
    """
    start = F.expr(f"pmod(digest, greatest(length(text) - {PASSAGE}, 0) + 1) + 1").cast("int")
    usable = (
        docs.where("text IS NOT NULL AND lang IS NOT NULL")
        .select("lang", "text", F.xxhash64("doc_id", "text").alias("digest"))
        .select("lang", "digest", F.col("text").substr(start, F.lit(PASSAGE)).alias("passage"))
    )
    counts = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # the least of many small groups first: a frequent language is not one task's
    salted = Window.partitionBy("lang", F.pmod("digest", F.lit(_SALTS))).orderBy("digest")
    whole = Window.partitionBy("lang").orderBy("digest")
    chosen = usable.select("lang", "digest").distinct()
    for window in (salted, whole):
        chosen = chosen.withColumn("nth", F.row_number().over(window)).where(F.col("nth") <= SAMPLED)
    chosen = chosen.select("lang", "digest")
    if SAMPLED * len(counts) <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    passages = usable.join(chosen, ["lang", "digest"], "left_semi").dropDuplicates(["lang", "digest"])
    held: dict[str, list[tuple[int, str]]] = {lang: [] for lang in counts}
    # SAMPLED passages of PASSAGE characters for a language at most
    for row in passages.collect():
        held[row["lang"]].append((row["digest"], row["passage"]))
    languages = sorted(counts, key=lambda lang: (-counts[lang], lang))
    joined = ["\n".join(passage for _, passage in sorted(held[lang])) for lang in languages]
    return Model(languages, [text.lower().encode() for text in joined])


def _compressor(content: bytes, level: int) -> Callable[[bytes], bytes]:
    if not content:
        return zstandard.ZstdCompressor(level=level, write_content_size=False).compress
    settings = zstandard.ZstdCompressionParameters.from_level(
        level, dict_size=len(content), min_match=_LEAST_MATCH,
        write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress


def sizes_of(model: Model) -> Callable[[str], list[int]]:
    """A function from a text to its compressed size with each dictionary."""
    long = [_compressor(content, _LEVEL) for content in model.dictionaries]
    short = [_compressor(content, _SHORT_LEVEL) for content in model.dictionaries]

    def sizes(text: str) -> list[int]:
        data = text.lower().encode()
        if len(data) < SHORT:
            return [len(compress(_CARRIER + data)) for compress in short]
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum(len(compress(block)) for block in blocks) for compress in long]

    return sizes


def _judge(model: Model) -> Callable[[str | None], tuple[str, float, bool]]:
    """A function from a text to its language, score and whether the margin is narrow."""
    sizes = sizes_of(model)

    def judge(text: str | None) -> tuple[str, float, bool]:
        if not model.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        found = sizes(text)
        best = min(range(len(found)), key=found.__getitem__)  # the first of equals
        others = [size - found[best] for i, size in enumerate(found) if i != best]
        # a byte more is eight bits less likely, and half a byte tells little
        score = 1 / (1 + sum(2.0 ** -min(8 * more, 1000) for more in others))
        narrow = bool(others) and min(others) < max(MARGIN, MARGIN_SHARE * found[best])
        return model.languages[best], score, narrow

    return judge


def predict(df: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected`` of its ``text``.

    One row for each row, repeated ones included. A text that is null or has no letter is
    ``und`` with score 0 and rejected, as is every text where nothing was learnt. Texts are
    read whole, whatever their length; an empty table stays empty; columns of these names
    are replaced and others kept. A rejected text keeps its likeliest language: whether to
    use it is the caller's choice.
    """
    # plain values: a broadcast is read without this package on the workers
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.dictionaries))

    def make() -> Callable[[list], list]:
        judge = _judge(Model(*shared.value))
        return lambda texts: list(zip(*map(judge, texts), strict=True)) or [[], [], []]

    fields = [
        StructField("lang_pred", StringType()),
        StructField("score", DoubleType()),
        StructField("rejected", BooleanType()),
    ]
    return append_columns(df, [F.col("text")], fields, make, keep)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    predicted = predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
