"""Token ids in files of directly addressable codes (DAC), in ascending order of documents.

An id is split into chunks of `BITS` bits. Level 0 holds the lowest chunk of every id, level k
the next chunk of those ids that have one. A bitmap at each level says which ids go on; a rank
directory holds the number of ones before every `BLOCK` bits. Id i is found by one byte, one bit
and one rank per level, with no block decoded; a run of ids is one slice per level.

File: 8 bytes MAGIC, unsigned 64-bit length of the header, header (JSON: counts, and of each array
its place and length), then the arrays: documents' ids and first tokens, and of each level chunks,
bitmap and rank directory. Files are written under a name of their own attempt, so a task that
runs again never harms one that is complete; only files in the returned manifest count.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, open_read, open_write, prefix_sum, sliced, staged
from .tokens import default_path, library_encoder, with_end

MAGIC, BITS, BLOCK = b"TLDAC001", 8, 512
READ_TOKENS = 250_000
MANIFEST = "partition int, number int, uri string, n_docs long, n_tokens long"


def dac_bytes(ids: np.ndarray, doc_ids: np.ndarray, first: np.ndarray, n_null: int = 0) -> bytes:
    """A whole file. `first` has the first token of each document and, at its end, the count of tokens;
    the first `n_null` documents have no id."""
    arrays: list[tuple[str, bytes]] = [("doc_ids", doc_ids.astype("<i8").tobytes()), ("first", first.astype("<u8").tobytes())]
    now, levels = ids.astype("<u4"), 0
    while levels == 0 or len(now):
        more = now >> BITS
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones)])
        arrays += [(f"chunk{levels}", (now & (2**BITS - 1)).astype(np.uint8).tobytes()), (f"bits{levels}", bits.tobytes()), (f"rank{levels}", ranks.astype("<u8").tobytes())]
        now, levels = more[goes_on], levels + 1
    places, at = {}, 0
    for name, data in arrays:
        places[name] = [at, len(data)]
        at += len(data)
    head = json.dumps({"n_docs": len(doc_ids), "n_null": n_null, "n_tokens": len(ids), "levels": levels, "arrays": places}).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *(x for _, x in arrays)])


class DacFile:
    """Reads any token, or any run of tokens, of one file by range reads."""

    def __init__(self, uri: str):
        self.file = open_read(uri)
        magic, size = struct.unpack("<8sQ", self.file.read(16))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.head = json.loads(self.file.read(size))
        self.base = 16 + size

    def part(self, name: str, start: int, length: int) -> bytes:
        place, size = self.head["arrays"][name]
        length = max(0, min(length, size - start))
        self.file.seek(self.base + place + start)
        return self.file.read(length)

    def rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a level."""
        block = i // BLOCK
        (known,) = struct.unpack("<Q", self.part(f"rank{level}", 8 * block, 8))
        bits = np.frombuffer(self.part(f"bits{level}", block * BLOCK // 8, BLOCK // 8), np.uint8)
        return known + int(np.unpackbits(bits, bitorder="little")[: i - block * BLOCK].sum())

    def token(self, i: int) -> int:
        """Id number i: at each level one chunk, one bit and one rank."""
        value = shift = level = 0
        while True:
            value |= self.part(f"chunk{level}", i, 1)[0] << shift
            if not self.part(f"bits{level}", i // 8, 1)[0] >> i % 8 & 1:
                return value
            i, level, shift = self.rank(level, i), level + 1, shift + BITS

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1; at each level they are neighbours."""
        out = np.zeros(b - a, "<u4")
        where, level = np.arange(b - a), 0
        while len(where):
            out[where] |= np.frombuffer(self.part(f"chunk{level}", a, b - a), np.uint8).astype("<u4") << np.uint32(BITS * level)
            bits = np.unpackbits(np.frombuffer(self.part(f"bits{level}", a // 8, (b + 7) // 8 - a // 8), np.uint8), bitorder="little")[a % 8 : a % 8 + b - a]
            where = where[bits.astype(bool)]
            if len(where):
                a = self.rank(level, a)
                b = a + len(where)
            level += 1
        return out

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.head["n_docs"]
        return np.frombuffer(self.part("doc_ids", 0, 8 * n), "<i8"), np.frombuffer(self.part("first", 0, 8 * n + 8), "<u8").astype(np.int64)

    def close(self) -> None:
        self.file.close()


def write_tokens(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 2, folder: str | None = None, file_tokens: int = 2_000_000
) -> DataFrame:
    """Encode, sort and write all documents; the manifest of files, with `start`: tokens in the files before.

    Texts are dealt by ranges of (doc_id, hash of the text) and sorted in each range, so files follow each
    other in ascending doc_id and rows of one id, or without id, may go to several tasks. Null or empty text:
    only the end id. Null ids come first; a file's header counts them. Rows of one id go by a hash of their
    text, repeated rows side by side. A text of any length is encoded whole. No rows: an empty manifest; other
    columns are ignored.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path("byte_bpe_50k.json")
    folder = folder or new_folder(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        part, number, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        nulls = 0

        def flush() -> pa.RecordBatch:
            names, first = np.concatenate([x[0] for x in held]), np.concatenate([[0], np.cumsum(np.concatenate([x[2] for x in held]))])
            uri = f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex[:8]}.dac"
            with open_write(uri) as f:
                f.write(dac_bytes(np.concatenate([x[1] for x in held]), names, first, nulls))
            row = {"partition": [part], "number": [number], "uri": [uri], "n_docs": [len(names)], "n_tokens": [int(first[-1])]}
            return pa.RecordBatch.from_arrays([pa.array(row["partition"], pa.int32()), pa.array(row["number"], pa.int32()), pa.array(row["uri"]), pa.array(row["n_docs"], pa.int64()), pa.array(row["n_tokens"], pa.int64())], list(row))

        for b in sliced(batches, 1024):
            ids, bounds = with_end(encoder.encode(b.column(1)), end_id)
            held.append((b.column(0).fill_null(0).to_numpy(), ids, np.diff(bounds)))
            nulls += b.column(0).null_count
            size += len(ids)
            if size >= file_tokens:
                yield flush()
                held, nulls, size, number = [], 0, 0, number + 1
        if held:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    place = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*place).sortWithinPartitions(*place, "text")
    files = staged(rows.mapInArrow(run, MANIFEST), "token-manifest")
    files = files.withColumn("place", F.col("partition").cast("long") * 65536 + F.col("number"))
    return prefix_sum(files, [], "place", "n_tokens", "start", block=65536 * 64)


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 (with_ids: ids) of each document."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for uri, start in zip(b["uri"], b["start"]):
                f = DacFile(uri)
                names, first = f.documents()
                i, nulls = 0, f.head["n_null"]
                while i < len(names):  # documents of about READ_TOKENS tokens at a time, one at least
                    end = max(i + 1, int(np.searchsorted(first, first[i] + READ_TOKENS, side="right")) - 1)
                    own, places, none, i = names[i:end], first[i : end + 1], max(0, min(end, nulls) - i), end
                    ids = f.tokens(int(places[0]), int(places[-1]))
                    pieces = [ids[a - places[0] : z - places[0]] for a, z in zip(places, places[1:])]
                    out = {"doc_id": pd.array(own, "Int64"), "start": start + places[:-1], "n_tokens": np.diff(places), "ids_crc32": [zlib.crc32(x.tobytes()) for x in pieces]}
                    out = pd.DataFrame(out | ({"ids": [x.astype(np.int64) for x in pieces]} if with_ids else {}))
                    out.iloc[:none, 0] = pd.NA
                    yield out
                f.close()

    n = max(1, manifest.count())
    return manifest.select("uri", F.col("start").cast("long")).repartition(n).mapInPandas(run, schema)
