"""Byte-level BPE encoding of a whole corpus.

Method: each pre-token holds a segment tree over the ranks of its adjacent pairs. The root yields
the leftmost pair of lowest rank; a merge updates three leaves and their ancestors, until no pair
can be merged. A pre-token of n bytes takes O(n log n), so texts without blanks and long runs of
one letter cost no more than their length. Words seen before come from a bounded table.

Defined cases: null and empty texts give an empty list; any other text, blank ones too, gives the
ids of its bytes; strings that look like special tokens are ordinary text. Every row of the input
gives one row, repeated rows too; further columns are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktally.llm.vocabularies import vocabulary_path

#: Fixed value: the pattern that splits text before the merges, white space as Unicode's property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words a Python worker remembers; when full, the table starts anew.
REMEMBERED_WORDS = 200_000
#: Longest pre-token (bytes) that is remembered.
REMEMBERED_BYTES = 64
NONE = 1 << 62


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token bytes, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Encoder:
    """Encodes text with the ranks of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text."""
        out: list[int] = []
        if not text:
            return out
        known, extend = self.known, out.extend
        for word in self.split(text):
            ids = known.get(word)
            if ids is None:
                data = word.encode("utf-8", "surrogatepass")
                ids = tuple(self.merge(data))
                if len(data) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED_WORDS:
                        known.clear()
                    known[word] = ids
            extend(ids)
        return out

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token, by a segment tree over the ranks of adjacent pairs."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        end = [*range(1, n + 1)]  # end[i]: where the piece that starts at i ends
        before = [*range(-1, n - 1)]  # before[i]: where the piece before it starts
        size = 1 << (n - 1).bit_length()
        # A leaf holds rank << 32 | position, so that the least leaf is the leftmost of the lowest rank.
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for i in range(size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left < right else right

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                other = tree[i ^ 1]
                if other < value:
                    value = other
                i >>= 1
                if tree[i] == value:
                    return
                tree[i] = value

        def pair(i: int) -> int:
            middle = end[i]
            rank = ranks.get(data[i : end[middle]]) if middle < n else None
            return NONE if rank is None else rank << 32 | i

        while (least := tree[1]) != NONE:
            i = least & 0xFFFFFFFF
            middle = end[i]
            end[i] = after = end[middle]
            if after < n:
                before[after] = i
            put(middle, NONE)
            put(i, pair(i))
            if (previous := before[i]) >= 0:
                put(previous, pair(previous))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[data[i : end[i]]])
            i = end[i]
        return ids


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary file."""
    data = shared.value
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(load_ranks(data))
    return _ENCODERS[key]


def share_vocabulary(df: DataFrame, path: str | None = None):
    """The vocabulary file (a fixed file of about a megabyte) as a broadcast value."""
    with open(path or vocabulary_path(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, ids): each row's text as a list of token ids."""
    shared = share_vocabulary(df, path)
    id_field = df.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(shared).encode
        for batch in batches:
            lists = [encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    schema = T.StructType([T.StructField(id_col, id_field.dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, n_tokens): the number of tokens of each row's text."""
    shared = share_vocabulary(df, path)
    id_field = df.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(shared).encode
        for batch in batches:
            counts = pa.array([len(encode(t)) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], [id_col, "n_tokens"])

    schema = T.StructType([T.StructField(id_col, id_field.dataType), T.StructField("n_tokens", T.LongType())])
    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
