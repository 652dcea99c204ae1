"""BPE encoding and decoding with a published vocabulary.

A word's bytes form a doubly linked list of symbols. A heap holds the adjacent pairs
that may merge, by merge rank and place; popping the best pair joins two symbols in
place and pushes the two new pairs, and entries whose symbols have changed meanwhile
are skipped. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from bazaarlens.llm.common import append_columns, filled, table

#: Words whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 300_000
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a published vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary's strings.

    Printable Latin-1 characters stand for themselves, the other bytes for the code
    points from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> dict:
    """Merges, byte strings by id and added tokens of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    ids = content["model"]["vocab"]
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    strings = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for string, i in ids.items():
        strings[i] = bytes(letters[c] for c in string)
    for string, i in added.items():
        strings[i] = string.encode()
    merges = {}
    for rank, pair in enumerate(content["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left], ids[right]] = (rank, ids[left + right])
    first = [0] * 256
    for letter, byte in letters.items():
        first[byte] = ids[letter]
    return {"merges": merges, "strings": strings, "bytes": first, "added": added}


def encode_word(word: bytes, merges: dict, first: list[int]) -> list[int]:
    """Ids of one word by merging the best-ranked adjacent pair until none is left."""
    symbols = [first[b] for b in word]
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        merge = merges.get((symbols[i], symbols[i + 1]))
        if merge:
            heap.append((merge[0], i, symbols[i], symbols[i + 1], merge[1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right, joined = heapq.heappop(heap)
        j = after[i]
        # stale: one of the two symbols has been merged into another since
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = joined, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            merge = merges.get((joined, symbols[k]))
            if merge:
                heapq.heappush(heap, (merge[0], i, joined, symbols[k], merge[1]))
        h = before[i]
        if h >= 0:
            merge = merges.get((symbols[h], joined))
            if merge:
                heapq.heappush(heap, (merge[0], h, symbols[h], joined, merge[1]))
    return [s for s in symbols if s >= 0]


def encoder(vocabulary: dict, remembered: int = REMEMBERED) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian 32-bit integers."""
    import regex

    # Fixed value: how the vocabulary's merges expect words to be split.
    words = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    ).findall
    merges, first, added = vocabulary["merges"], vocabulary["bytes"], vocabulary["added"]
    special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
    packed = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}

    class Memory(dict):
        def __missing__(self, word: str) -> bytes:
            ids = encode_word(word.encode("utf-8"), merges, first)
            value = np.array(ids, "<u4").tobytes()
            if len(word) <= 64:
                if len(self) >= remembered:
                    self.clear()
                self[word] = value
            return value

    of = Memory().__getitem__

    def encode(text: str) -> bytes:
        if special is None or not any(token in text for token in added):
            return b"".join(map(of, words(text)))
        parts = []
        for i, part in enumerate(special.split(text)):
            parts += [packed[part]] if i % 2 else map(of, words(part))
        return b"".join(parts)

    return encode


def decoder(vocabulary: dict) -> Callable[[bytes], str]:
    """A function from packed ids to the text."""
    of = vocabulary["strings"].__getitem__

    def decode(packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(of, ids)).decode("utf-8", "replace")

    return decode


def _shared(df: DataFrame, path: str | None):
    """The vocabulary, read on the driver and sent once: its size is fixed."""
    read = read_vocabulary(path or vocabulary_path())
    return df.sparkSession.sparkContext.broadcast(read)


def encode(df: DataFrame, path: str | None = None, decoded: bool = False) -> DataFrame:
    """``df`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of its ``text``.

    One row for each row, repeated ones included; a null text is empty and has no
    ids, an empty table stays empty, texts are encoded whole whatever their length,
    columns of these names are replaced. Strings of added tokens get their ids. With
    ``decoded`` the ids are decoded as ``decode`` does, in the same pass: a second one
    would keep a second worker, with a vocabulary of its own, beside each task's first.
    """
    shared = _shared(df, path)

    def make() -> Callable[[list], list]:
        of, to_text = encoder(shared.value), decoder(shared.value)

        def work(texts: list) -> list:
            packed = [of(t or "") for t in texts]
            back = [[to_text(p) for p in packed]] if decoded else []
            return [[len(p) // 4 for p in packed], packed, *back]

        return work

    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
    if decoded:
        fields.append(StructField("decoded", StringType()))
    return append_columns(df, ["text"], fields, make)


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` with ``decoded``, the text of its ``ids``; null or no ids give an empty text."""
    from pyspark.sql import functions as F

    shared = _shared(df, path)

    def make() -> Callable[[list], list]:
        of = decoder(shared.value)
        return lambda ids: [[of(x) for x in ids]]

    given = F.coalesce(F.col("ids"), F.lit(b"").cast("binary"))
    return append_columns(df, [given], [StructField("decoded", StringType())], make)


def round_trip(df: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoding and decoding.

    The same work as ``encode`` and ``decode`` in one pass, of which only digests
    leave the worker.
    """
    shared = _shared(df, path)

    def make() -> Callable[[list], list]:
        to_ids, to_text = encoder(shared.value), decoder(shared.value)

        def work(texts: list) -> list:
            counts, ids, decoded = [], [], []
            for text in texts:
                packed = to_ids(text)
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(to_text(packed).encode()).hexdigest())
            return [counts, ids, decoded]

        return work

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return append_columns(df, [filled()], fields, make, keep)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return round_trip(table(spark, sf_dir, "documents"), keep=["doc_id"])
