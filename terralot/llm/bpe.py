"""Byte-level BPE: encoding by merge ranks, and decoding.

Method: a segment tree over the byte positions of a match holds, at each node, the least
(rank, position) of a pair that may merge, so its root is the leftmost pair of the least rank.
A merge changes the ranks of the merged pair and of its two live neighbours: three point updates
of logarithmic cost. A match of n bytes takes O(n log n), whatever its length.
"""

from __future__ import annotations

import array
import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced
from .tokens import ChunkEncoder, Encoded, default_path

NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encode_match(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of the pattern."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1
    while size < n - 1:
        size *= 2
    tree = [NONE] * (2 * size)
    rank = ranks.get
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    ends = list(range(1, n + 1))  # where the live part that begins here ends
    before = list(range(-1, n - 1))  # where the live part before begins

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            if b < a:
                a = b
            if tree[i] == a:
                return
            tree[i] = a
            i >>= 1

    while (best := tree[1]) < NONE:
        i = best & 0xFFFFFFFF
        j = ends[i]  # the right part, which the merge takes in
        end = ends[i] = ends[j]
        put(j, NONE) if j < n - 1 else None
        if end < n:
            before[end] = i
            r = rank(piece[i : ends[end]])
            put(i, NONE if r is None else r << 32 | i)
        else:
            put(i, NONE)
        p = before[i]
        if p >= 0:
            r = rank(piece[p:end])
            put(p, NONE if r is None else r << 32 | p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


_encoders: dict[tuple[str, str], tuple[ChunkEncoder, list[bytes]]] = {}


def vocabulary_encoder(vocabulary: str, pattern: str) -> tuple[ChunkEncoder, list[bytes]]:
    """The encoder of a rank file and the bytes of each id; one a process, so that what it keeps serves all its tasks."""
    if (vocabulary, pattern) not in _encoders:
        ranks = load_ranks(vocabulary)
        bytes_of: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for k, v in ranks.items():
            bytes_of[v] = k
        _encoders[vocabulary, pattern] = bpe_encoder(ranks, pattern), bytes_of
    return _encoders[vocabulary, pattern]


def bpe_encoder(ranks: dict[bytes, int], pattern: str, entries: int = 400_000) -> ChunkEncoder:
    """Encodes texts match by match; at most `entries` matches and as many chunks are kept."""
    import regex

    find = regex.compile(pattern).findall
    known: dict[str, bytes] = {}

    def many(texts: list[str]) -> Encoded:
        if len(known) > entries:
            known.clear()
        parts, sizes = [], []
        for text in texts:
            n = 0
            for match in find(text):
                ids = known.get(match)
                if ids is None:
                    ids = array.array("I", encode_match(match.encode(), ranks)).tobytes()
                    if len(match) <= 48:
                        known[match] = ids
                parts.append(ids)
                n += len(ids) // 4
            sizes.append(n)
        return np.frombuffer(b"".join(parts), np.uint32), np.array(sizes, np.int64)

    return ChunkEncoder(lambda chunks: many([" " + x for x in chunks.to_pylist()]), many, entries=entries)


def encode_decode(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (with_ids: ids, decoded) of each row, in place, with no shuffle.

    Null and empty texts have no ids. Lone surrogates can't occur in Spark's strings. Null and
    repeated ids are passed on row by row; other columns are ignored.
    """
    import public_tokenizers

    vocabulary = vocabulary or default_path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bytes_of = vocabulary_encoder(vocabulary, pattern)
        decimal = [str(i) for i in range(len(bytes_of))]
        for b in sliced(batches):
            n, digest, back, kept, raw = [], [], [], [], []
            made, bounds = encoder.encode(b.column(1))
            for start, end in zip(bounds.tolist(), bounds[1:].tolist()):
                ids = made[start:end].tolist()
                decoded = b"".join(map(bytes_of.__getitem__, ids))
                n.append(len(ids))
                digest.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    kept.append(ids)
                    raw.append(decoded)
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(digest), pa.array(back)]
            if with_ids:
                columns += [pa.array(kept, pa.list_(pa.int64())), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
