"""Mixture-controlled packing of documents into fixed windows.

Method: deficit round-robin over source queues. Every source has a target share of the tokens
(given weights, or its natural share). Each window adds share x window tokens to each queue's deficit
and is filled from the queues in proportion to what they are owed, in whole tokens by largest
remainder; what a queue got less or more is carried to the next window. A queue whose quota is below
`min_piece` waits until it is owed so many, so documents of small sources aren't cut to single tokens.
So a full window's distance from the mixture (total variation) is at most the share of such small
sources and a token for each other source, as long as no queue has run out.

Partitions (buckets of about `bucket_tokens` tokens) are cut by each source's own cumulative count of
tokens divided by its share, so every bucket holds the target mixture and documents are cut where a
bucket ends. What a cut leaves owed is carried on as the next bucket's deficit. A source's tokens are
counted in the order of the input's tasks and rows, by prefix sums over tasks, so cuts depend on how
the input is dealt; which tokens are packed doesn't.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_sum, sliced, staged
from .tokens import as_binary, default_path, forget_chunks, library_encoder, with_end

WINDOW, MIN_PIECE, BUCKET_TOKENS = 1024, 16, 1 << 19
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, padding long, ids binary"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, ids, n, part, before): ids as little-endian unsigned 16-bit or, for larger vocabularies, 32-bit;
    the task, and the tokens of the row's source before it in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for b in sliced(batches, 1024):
            ids, bounds = with_end(encoder.encode(b.column(2)), end_id)
            sizes = np.diff(bounds)
            before = []
            for k, n in zip(b.column(1).to_pylist(), sizes.tolist()):
                before.append(seen.get(k, 0))
                seen[k] = before[-1] + n
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), as_binary(ids, bounds), pa.array(sizes), pa.array([part] * len(sizes), pa.int64()), pa.array(before, pa.int64())], ["doc_id", "source", "ids", "n", "part", "before"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("\x00")).alias("source"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, ids binary, n long, part long, before long")


def windows_of(total: int, window: int) -> Iterator[int]:
    """Lengths of the sequences that hold `total` tokens: full windows, then the rest cut at powers of two."""
    for _ in range(total // window):
        yield window
    rest, size = total % window, 1 << max(0, window.bit_length() - 1)
    while rest:
        if size <= rest:
            yield size
            rest -= size
        size >>= 1


def apportioned(total: int, wanted: np.ndarray, most: np.ndarray) -> np.ndarray:
    """`total` tokens in proportion to `wanted`, whole, by largest remainder, none above `most`; less if `most` of those wanted is less."""
    got = np.zeros(len(wanted), np.int64)
    while total > 0:
        w = np.where(got < most, wanted, 0.0)
        if not w.any():
            break
        ideal = total * w / w.sum()
        part = np.minimum(np.floor(ideal).astype(np.int64), most - got)
        rest = int(total - part.sum())
        if rest:
            remainder = np.where((w > 0) & (part < most - got), ideal - part, -1.0)
            best = np.argsort(-remainder, kind="stable")[:rest]
            part[best[remainder[best] >= 0]] += 1
        got += part
        total -= int(part.sum())
    return got


def served(left: np.ndarray, shares: np.ndarray, deficits: np.ndarray, sizes: list[int], min_piece: int) -> np.ndarray:
    """Deficit round-robin: the tokens that each window (row) takes from each queue (column).

    `left` has the tokens in each queue, `sizes` the windows' lengths, which take all of them. Shares of queues that have
    run out go to the others in proportion; queues without a share count as equal when only they are left.
    """
    out = np.zeros((len(sizes), len(left)), np.int64)
    left, deficits = left.astype(np.int64), deficits.astype(np.float64)
    for i, size in enumerate(sizes):
        share = np.where(left > 0, shares, 0.0)
        if not share.any():
            share = (left > 0).astype(np.float64)
        deficits = np.where(left > 0, deficits + size * share / share.sum(), 0.0)
        owed = np.where(deficits >= np.minimum(min_piece, left), np.maximum(deficits, 0), 0)
        got = apportioned(size, owed, left)
        for others in (share, np.ones(len(left))):  # those not yet owed a piece, and those without a share, fill what is left of the window
            rest = size - int(got.sum())
            got = got + apportioned(rest, others, left - got) if rest else got
        out[i] = got
        left, deficits = left - got, deficits - got
    return out


def packed_bucket(rows: pa.Table, window: int, min_piece: int, with_ids: bool) -> pa.Table:
    """The pieces of one bucket. Its tokens lie in the order of sources and, in each, of documents; pieces end where a document ends or a window's part of a source."""
    rows = rows.append_column("crc", pa.array([zlib.crc32(x) for x in rows["ids"].to_pylist()], pa.int64()))
    rows = rows.take(pc.sort_indices(rows, [(k, "ascending") for k in ("source", "doc_id", "crc", "first")], null_placement="at_start")).combine_chunks()
    n, first = rows["n"].to_numpy(), rows["first"].to_numpy()
    flat = np.concatenate([np.frombuffer(x, "<u2" if len(x) == 2 * k else "<u4") for x, k in zip(rows["ids"].to_pylist(), n.tolist())]).astype("<u4")
    names = rows["source"].combine_chunks().dictionary_encode()
    source = names.indices.to_numpy()
    begin = np.flatnonzero(np.diff(source, prepend=-1))
    shares = rows["share"].to_numpy()[begin]
    queues = np.add.reduceat(n, begin)
    sizes = list(windows_of(int(n.sum()), window))
    parts = served(queues, shares if shares.any() else queues.astype(np.float64), rows["carry"].to_numpy()[begin], sizes, min_piece)
    cells = parts.T.reshape(-1)
    doc_ends, cell_ends = np.cumsum(n), np.cumsum(cells)
    end = np.union1d(doc_ends, cell_ends[cells > 0])
    start = np.concatenate([[0], end[:-1]])
    doc, cell = np.searchsorted(doc_ends, start, side="right"), np.searchsorted(cell_ends, start, side="right")
    queue, number = cell // len(sizes), cell % len(sizes)
    offset = (np.cumsum(parts, axis=1) - parts)[number, queue] + start - (cell_ends - cells)[cell]
    data = memoryview(flat.view(np.uint8))
    pieces = [data[4 * a : 4 * z] for a, z in zip(start.tolist(), end.tolist())]
    bucket = rows["bucket"][0].as_py()
    at = pa.array(doc)
    columns = [
        rows["doc_id"].take(at), pa.array(first[doc] + start - (doc_ends - n)[doc]), pa.array(end - start), pa.array(list(map(zlib.crc32, pieces)), pa.int64()), rows["whole"].take(at),
        pa.array((bucket << 32) + number), pa.array(offset), rows["source"].take(at), pa.array(np.zeros(len(doc), np.int64)), pa.array(map(bytes, pieces) if with_ids else [None] * len(doc), pa.binary()),
    ]
    return pa.table(columns, names=[x.split()[0] for x in PIECES.split(", ")])


def legs(totals: list[tuple[int, float]]) -> list[tuple[float, float, float]]:
    """(time, tokens served before, tokens a unit of time) of each stretch in which the same sources last.

    A source of n tokens and share w lasts n / w; in a unit of time each that lasts gives its share.
    After all of them a unit of time is a token. Totals are pairs (n, w)."""
    ends = sorted((n / w, w) for n, w in totals if n and w > 0)
    out, time, done, rate = [], 0.0, 0.0, sum(w for _, w in ends)
    for i, (end, w) in enumerate(ends):
        if end > time:
            out.append((time, done, rate))
            done += rate * (end - time)
            time = end
        rate = sum(x for _, x in ends[i + 1 :])
    return [*out, (time, done, 1.0)]


def along(x: Column, stretches: list[tuple[float, float, float]], back: bool) -> Column:
    """Tokens served before a time or, back, the time at which so many are served."""
    at = lambda t, d, r: F.lit(t) + (x - F.lit(d)) / F.lit(r) if back else F.lit(d) + (x - F.lit(t)) * F.lit(r)
    out = at(*stretches[0])
    for t, d, r in stretches[1:]:
        out = F.when(x >= F.lit(d if back else t), at(t, d, r)).otherwise(out)
    return out


def dealt(rows: DataFrame, stretches: list[tuple[float, float, float]], buckets: int, bucket_tokens: int) -> DataFrame:
    """Parts of documents by bucket. rows have `at`, the tokens of their source before them, and of the
    source all (its tokens), rate (tokens in a unit of time) and since (when it begins)."""
    ideal = lambda k: F.col("rate") * (along(k * F.lit(float(bucket_tokens)), stretches, True) - F.col("since"))

    def cut(k: Column) -> Column:
        """The tokens of the source before bucket k."""
        inside = F.least(F.greatest(F.floor(ideal(k)), F.lit(0)), F.col("all"))
        return F.when(k <= 0, F.lit(0)).when(k >= F.lit(buckets), F.col("all")).otherwise(inside).cast("long")

    def about(c: Column) -> Column:
        k = F.floor(along(F.col("since") + c / F.col("rate"), stretches, False) / F.lit(bucket_tokens))
        return F.least(F.greatest(k, F.lit(0)), F.lit(buckets - 1)).cast("long")

    end = F.col("at") + F.col("n")
    # a token lies in the bucket its ideal place is in or, as cuts are whole tokens, in a neighbour
    rows = rows.withColumn("k0", about(F.col("at"))).withColumn("k1", about(end + 1))
    rows = rows.withColumn("k0", F.when(cut(F.col("k0")) > F.col("at"), F.greatest(F.col("k0") - 1, F.lit(0))).otherwise(F.col("k0")))
    width = F.floor(F.length("ids") / F.col("n")).cast("int")

    def piece(k: Column) -> Column:
        start, stop = F.greatest(cut(k), F.col("at")), F.least(cut(k + 1), end)
        ids = F.substring("ids", ((start - F.col("at")) * width + 1).cast("int"), (F.greatest(stop - start, F.lit(0)) * width).cast("int"))
        carry = F.when((F.col("share") > 0) & (k > 0), F.greatest(ideal(k) - cut(k), F.lit(0.0))).otherwise(0.0)
        return F.struct(k.alias("bucket"), (start - F.col("at")).alias("first"), (stop - start).alias("n"), carry.alias("carry"), ids.alias("ids"))

    pieces = F.transform(F.sequence("k0", F.least(F.col("k1") + 1, F.lit(buckets - 1))), piece)  # the whole row of ids is not repeated
    rows = rows.select("source", "doc_id", F.col("n").alias("whole"), "share", F.explode(pieces).alias("p")).filter("p.n > 0")
    return rows.select("p.bucket", "source", "doc_id", "whole", "p.first", "p.n", "share", "p.carry", "p.ids")


def pack(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: dict[str, float] | None = None, tokenizer: str | None = None, end_id: int = 0,
    window: int = WINDOW, min_piece: int = MIN_PIECE, bucket_tokens: int = BUCKET_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where which tokens of a document went (with_ids: the tokens too).

    weights: target shares by source; missing sources get none and come last. None: natural shares.
    Every token lies in exactly one piece. Sequences are full windows; the tokens left at the end
    of a bucket go to sequences of decreasing powers of two, so nothing is padded.
    A null or empty text has only its end id. A null source is a queue of its own. Null and
    repeated ids and repeated rows are packed row by row. A long text is cut wherever a window's part
    of its source ends. Ties between sources go in the order of their names. No rows give no pieces;
    other columns are ignored.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path("byte_bpe_50k.json")
    rows = staged(encoded(docs, tokenizer, end_id, doc_id, text, source), "pack-ids")
    counts = staged(rows.groupBy("source", "part").agg(F.sum("n").alias("c")), "pack-counts")
    total = counts.agg(F.sum("c")).first()[0] or 0
    buckets = max(1, -(-total // bucket_tokens))
    of_source = counts.groupBy("source").agg(F.sum("c").alias("all"))
    if weights is None:
        share, stretches = F.col("all") / F.lit(max(1, total)), [(0.0, 0.0, 1.0)]
        of_source = of_source.select("source", "all", share.alias("share"), share.alias("rate"), F.lit(0.0).alias("since"))
    else:
        known = {k: float(v) / sum(weights.values()) for k, v in weights.items() if v > 0}
        of_source = of_source.join(F.broadcast(spark.createDataFrame(list(known.items()), "source string, share double")), "source", "left")  # the caller's weights
        of_source = staged(of_source.select("source", "all", F.coalesce("share", F.lit(0.0)).alias("share")), "pack-sources")
        stretches = legs([(r["all"], r["share"]) for r in of_source.filter("share > 0").collect()])
        time, done, _ = stretches[-1]
        rest = F.col("share") == 0
        of_source = of_source.withColumn("rate", F.when(rest, F.col("all") / F.lit(max(1.0, total - done))).otherwise(F.col("share"))).withColumn("since", F.when(rest, F.lit(time)).otherwise(0.0))
    ahead = prefix_sum(counts, ["source"], "part", "c", "ahead").select("source", "part", "ahead")
    parts = staged(ahead.join(of_source, "source"), "pack-parts")  # of known size: broadcast if small
    placed = rows.join(parts, ["source", "part"]).withColumn("at", F.col("ahead") + F.col("before"))

    def run(rows: pa.Table) -> pa.Table:
        forget_chunks()  # the worker may have encoded before
        return packed_bucket(rows, window, min_piece, with_ids)

    pieces = dealt(placed, stretches, buckets, bucket_tokens).groupBy("bucket").applyInArrow(run, PIECES)
    pieces = pieces.withColumn("source", F.nullif("source", F.lit("\x00")))
    return pieces if with_ids else pieces.drop("ids")
