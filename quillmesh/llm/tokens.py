"""Encoding of the whole corpus with a public byte-level BPE vocabulary.

Method: a text is split by the vocabulary's pattern into pieces; over the adjacent pairs of a piece stands a
segment tree of their ranks, whose root yields the leftmost pair of lowest rank. The pair is merged, the two
ranks beside it are updated in logarithmic time, until no pair can be merged: n log n for a piece of n bytes,
also where a "word" has a million of them. Pieces recur, so each worker keeps those it has met, up to a bound.

The vocabulary (a fixed file of under 1 MB) is read by the driver from a path and sent to the workers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quillmesh.storage import pick, spread

#: The name of the vocabulary whose path is used where none is given.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces a worker remembers, and the longest it remembers, in characters.
KEPT_PIECES = 1 << 18
KEPT_LENGTH = 64
#: Ids a worker gathers before it sends them on.
IDS_PER_BATCH = 1 << 20

# Fixed value: the pattern that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NO_RANK = 1 << 60


def default_path() -> str:
    """Where the installed package of public tokenizers keeps the vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a line has a token in base64, a blank and its rank, which is its id."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


class PairTree:
    """Ranks of the adjacent pairs of a piece; the root holds the lowest."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        self.tree = [NO_RANK] * self.size + ranks + [NO_RANK] * (self.size - len(ranks))
        for node in range(self.size - 1, 0, -1):
            left, right = self.tree[2 * node], self.tree[2 * node + 1]
            self.tree[node] = left if left <= right else right

    def lowest(self) -> int:
        """The place of the leftmost lowest rank; -1 when no pair has one."""
        tree, node = self.tree, 1
        if tree[1] == NO_RANK:
            return -1
        while node < self.size:
            node *= 2
            if tree[node] > tree[node + 1]:
                node += 1
        return node - self.size

    def put(self, place: int, rank: int) -> None:
        tree, node = self.tree, place + self.size
        tree[node] = rank
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            lower = left if left <= right else right
            if tree[node] == lower:
                return
            tree[node] = lower
            node >>= 1


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one piece."""
    n = len(piece)
    if n == 1:
        return (ranks[piece],)
    parts: list[bytes] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = PairTree([ranks.get(piece[i : i + 2], NO_RANK) for i in range(n - 1)])
    while (i := tree.lowest()) >= 0:
        j = after[i]
        k = after[j]
        parts[i] += parts[j]
        after[i] = k
        if j < n - 1:
            tree.put(j, NO_RANK)
        if k < n:
            before[k] = i
            tree.put(i, ranks.get(parts[i] + parts[k], NO_RANK))
        else:
            tree.put(i, NO_RANK)
        if (h := before[i]) >= 0:
            tree.put(h, ranks.get(parts[h] + parts[i], NO_RANK))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[parts[i]])
        i = after[i]
    return tuple(ids)


class Encoder:
    """Encodes texts; strings that look like special tokens are ordinary text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall
        self.kept: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str) -> list[tuple[int, ...]]:
        names = self.split(text)
        found = list(map(self.kept.get, names))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    name = names[i]
                    ids = self.kept.get(name)
                    if ids is None:
                        ids = merge_piece(name.encode(), self.ranks)
                        if len(name) <= KEPT_LENGTH:
                            if len(self.kept) >= KEPT_PIECES:
                                self.kept.clear()
                            self.kept[name] = ids
                    found[i] = ids
        return found

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.pieces(text)))

    def count(self, text: str) -> int:
        return sum(map(len, self.pieces(text)))


_ENCODERS: dict[bytes, Encoder] = {}


def encoder_of(content: bytes) -> Encoder:
    """One encoder per vocabulary in each worker, with the pieces it remembers."""
    key = hashlib.blake2b(content).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(parse_ranks(content))
    return _ENCODERS[key]


def _vocabulary(spark: SparkSession, path: str | None):
    with open(path or default_path(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_corpus(df: DataFrame, *, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """The ids of every text: key, ids (array of int), one row per row of ``df``.

    No special tokens are added or recognised. An empty text and a null one have the empty list; a text of
    white space has the ids of its white space. Keys, also null or repeated ones, are passed through. Texts are
    encoded whole, whatever their length. An empty table gives no rows. Of further columns nothing is read.
    """
    content = _vocabulary(df.sparkSession, vocabulary)
    rows = spread(pick(df, key=key, text=text))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        for batch in batches:
            start, ids, ends = 0, [], [0]
            for i, value in enumerate(batch.column(1)):
                held = value.as_py()
                if held:
                    ids += encoder.encode(held)
                ends.append(len(ids))
                if len(ids) >= IDS_PER_BATCH or i + 1 == batch.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, i + 1 - start), lists], names=["key", "ids"])
                    start, ids, ends = i + 1, [], [0]

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, f"key {kind}, ids array<int>")


def count_tokens(df: DataFrame, *, text: str, keep: tuple[str, ...], vocabulary: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row and ``tokens``, the number of ids of its text (0 for an empty or null text)."""
    content = _vocabulary(df.sparkSession, vocabulary)
    rows = spread(pick(df, **{c: c for c in keep}, _text=text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            tokens = [encoder.count(held) if (held := value.as_py()) else 0 for value in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(tokens, pa.int64())], names=[*keep, "tokens"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(count, f"{kinds}, tokens long")
