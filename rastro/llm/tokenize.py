"""Encoding of a corpus with a public byte-level BPE vocabulary.

Method: a text is split by the vocabulary's pattern; each piece that is no token itself is merged with a segment tree
over its byte positions that stores the leftmost minimum pair rank, so every merge costs a few point updates of
logarithmic depth on the live neighbours, and a piece of n bytes O(n log n), however long it is. Pieces recur, so each
task remembers the ones it has met, in a table of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.session import spread

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
# Fixed value: the pattern that splits text before merging, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
REMEMBERED = 400_000  # pieces a task remembers
LONG = 64  # longer pieces are not remembered
_NONE = 1 << 62


def load_ranks(folder: str = TOKENIZERS, name: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes and their ids of a ``.tiktoken`` file: base64 and rank per line."""
    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes texts to ids with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the leftmost pair of least rank is merged until no adjacent pair is a token."""
        ranks, n = self.ranks, len(piece)
        if n == 1:
            return [ranks[piece]]
        width = 1 << (n - 2).bit_length() if n > 2 else 1
        shift = width.bit_length()
        tree = [_NONE] * (2 * width)  # a leaf holds rank << shift | position of the pair that starts there
        get = ranks.get
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                tree[width + i] = rank << shift | i
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        # Piece boundaries: part i covers piece[i : end[i]]; back[i] is the part before it.
        end, back = list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << shift) - 1

        def put(i: int, value: int) -> None:
            k = width + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                least = a if a < b else b
                if tree[k] == least:
                    return
                tree[k] = least
                k >>= 1

        while tree[1] != _NONE:
            i = tree[1] & mask
            j = end[i]
            stop = end[j]
            end[i] = stop
            if j < n - 1:
                put(j, _NONE)
            if stop < n:
                back[stop] = i
                rank = get(piece[i : end[stop]])
                put(i, _NONE if rank is None else rank << shift | i)
            else:
                put(i, _NONE)
            h = back[i]
            if h >= 0:
                rank = get(piece[h:stop])
                put(h, _NONE if rank is None else rank << shift | h)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(raw)
        ids = (rank,) if rank is not None else tuple(self.merge(raw))
        if len(text) <= LONG:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text`` without special tokens; none for null and empty texts."""
        out: list[int] = []
        known, extend = self.known, out.extend
        for piece in self.find(text) if text else ():
            extend(known.get(piece) or self._piece(piece))
        return out


def _encode_batches(batches: Iterator[pa.RecordBatch], shared, lengths: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(shared.value)
    for batch in batches:
        ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        if lengths:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes)], names=["doc_id", "n_tokens"])
            continue
        flat = np.fromiter((i for row in ids for i in row), np.int32, int(sizes.sum()))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])


def encode_corpus(documents: DataFrame, *, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, lengths: bool = False) -> DataFrame:
    """``doc_id, ids`` (or ``doc_id, n_tokens`` with ``lengths``) of each row, in the vocabulary's own ids.

    Null and empty texts give an empty list; repeated rows give a row each; texts of any length are encoded whole; extra
    columns are ignored; an empty table gives an empty result. The vocabulary (a few MB, whatever the corpus) is read on
    the driver and broadcast.
    """
    shared = documents.sparkSession.sparkContext.broadcast(load_ranks(folder, vocabulary))
    rows = spread(documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), "doc_id")
    schema = "doc_id bigint, n_tokens bigint" if lengths else "doc_id bigint, ids array<int>"
    return rows.mapInArrow(lambda batches: _encode_batches(batches, shared, lengths), schema)
