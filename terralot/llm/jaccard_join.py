"""Similarity self-join of documents on word shingles: grouped prefix join, exact.

Steps. (1) Each text becomes its set of hashed shingles; documents of equal sets are one class, the
node of the graph. (2) A table of slots, sized by the input, counts the shingles of all documents; sets
are ordered by slot count and hash, so rare shingles come first (any such order gives the same result;
a good one gives fewer candidates). (3) Two sets of similarity t share one of their first
n - ceil(t n) + 1 shingles: the prefix. Classes of identical prefix and size form one group. (4) Groups
that share a prefix shingle are paired; a pair must satisfy the places of the shared shingle, the
sizes, and, for groups of one class, a lower bound on the sets' difference (the bits in which their
parity sketches differ). A shingle of many groups is cut into blocks, and pairs of blocks go to
different tasks. Of a shingle's pairs first only a spanning forest is tried, then all pairs that its
links leave in different components. (5) Pairs are verified on the whole sets: those of groups of one
class one by one, others by expanding both groups to their members, block against block, where a forest
of the links found goes on. (6) Components of the links: stars within tasks, then smallest labels and
pointer jumping. (7) Links only run within components; there all pairs are compared, block against block,
and only each class's count of links goes on. So every link counts and no list of all pairs is made.

No pair is dropped by any limit: filters are bounds that hold for every linked pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import count_blocks, estimated_bytes, release, sliced, staged, sum_blocks

#: The slot table has a slot for every two bytes of the input as Spark estimates it, within these powers of two.
LEAST_BITS, MOST_BITS, SLOT_BLOCK = 14, 22, 4096
SKETCH_WORDS = 8
BLOCK_GROUPS = 128
#: Classes that meet in a block: BLOCK_CLASSES, but no more than FEW_BLOCKS blocks up to MOST_CLASSES each, and BLOCK_BYTES of sets.
BLOCK_CLASSES, FEW_BLOCKS, MOST_CLASSES, BLOCK_BYTES = 128, 8, 1024, 16 << 20
LEAST_SIDE, SQUARE_BYTES = 8, 6 << 20
UNION_LINKS = 1_000_000
#: Shingles that a task counts at a time.
COUNTED = 2_000_000
P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words(dict):
    """Word hashes, kept as they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingles:
    """texts -> sorted arrays of distinct 64-bit hashes of n-word shingles; A-Z lower-cased, words
    between the six ASCII spaces. A text of fewer words is one shingle; without words, none."""

    def __init__(self, n: int, entries: int = 400_000):
        self.n, self.entries, self.words = n, entries, Words()

    def of(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        words = text.encode().lower().split()
        if len(self.words) > self.entries:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        k = min(self.n, len(h))
        if not k:
            return h
        x = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            x = (x + h[i : len(h) - k + 1 + i]) * P1
            x ^= x >> np.uint64(29)
            x *= P2
            x ^= x >> np.uint64(32)
        return np.unique(x)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def set_key(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def sketch_of(s: np.ndarray) -> bytes:
    """Bit b: parity of the count of shingles that fall on b. Two sketches differ in no more bits than the sets in shingles."""
    width = 64 * SKETCH_WORDS
    bits = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def shapes(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """A row per document (doc_id, text_hash, n, h1, h2), and rows (block, counts) with the slot counts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        counts, held, size = np.zeros(1 << bits, np.int64), [], 0
        names = ["doc_id", "text_hash", "n", "h1", "h2", "block", "counts"]
        for b in sliced(batches):
            sets = [shingles.of(t) for t in b.column(2).to_pylist()]
            held.append((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int32))
            size += len(held[-1])
            if size >= COUNTED:
                counts += np.bincount(np.concatenate(held), minlength=1 << bits)
                held, size = [], 0
            keys = [set_key(s) for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), none, pa.nulls(len(sets), pa.binary())],
                names,
            )
        if held:
            counts += np.bincount(np.concatenate(held), minlength=1 << bits)
        used, packed = count_blocks(counts, SLOT_BLOCK)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, n long, h1 long, h2 long, block int, counts binary")


def prefixes(docs: DataFrame, n: int, percent: int, bits: int, counts) -> DataFrame:
    """doc_id, n, h1, h2, prefix (rarest first), p1, p2 (its hash), sketch, of every document with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = Shingles(n), counts.value
        for b in sliced(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingles.of(text)
                if not len(s):
                    continue
                length = len(s) + (-percent * len(s)) // 100 + 1
                order = np.lexsort((s, often[(s >> np.uint64(64 - bits)).astype(np.int64)]))[:length]
                prefix = s[order]
                for column, value in zip(out, (doc_id, len(s), *set_key(s), signed(prefix), *set_key(prefix), sketch_of(s))):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.int64()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "n", "h1", "h2", "prefix", "p1", "p2", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, h1 long, h2 long, prefix array<long>, p1 long, p2 long, sketch binary")


def in_runs(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, list[tuple[int, int]]], pa.RecordBatch], schema: str, most: int = 100_000, most_bytes: int = 32 << 20) -> DataFrame:
    """`work` over whole runs of equal keys (long columns) of sorted rows: a table and the places of its runs, about `most` rows or `most_bytes` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def cuts(t: pa.Table) -> np.ndarray:
            new = np.zeros(max(0, t.num_rows - 1), bool)
            for k in keys:
                v = t.column(k).to_numpy()
                new |= v[1:] != v[:-1]
            return np.flatnonzero(new) + 1

        def ended(t: pa.Table, at: np.ndarray) -> pa.RecordBatch:
            return work(t, list(zip([0, *at.tolist()], [*at.tolist(), t.num_rows])))

        for b in batches:
            for part in sliced([b], most, most_bytes):
                held.append(part)
                if sum(x.num_rows for x in held) < most and sum(x.nbytes for x in held) < most_bytes:
                    continue
                t = pa.Table.from_batches(held)
                at = cuts(t)
                if len(at):  # the last run may go on
                    yield ended(t.slice(0, at[-1]), at[:-1])
                    t = t.slice(at[-1])
                held = t.combine_chunks().to_batches()
        if held:
            t = pa.Table.from_batches(held)
            yield ended(t, cuts(t))

    return rows.mapInArrow(run, schema)


def dealt(rows: DataFrame, keys: list[str], x: str, y: str, parts: Column) -> DataFrame:
    """Rows sorted by keys, x, y; the pairs of blocks of one key go to tasks one after another, so none gets many of them."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    home = F.pmod(F.pmod(F.xxhash64(*keys), F.lit(tasks)) + F.col(x) * parts + F.col(y), F.lit(tasks)).cast("int")
    return rows.repartitionById(tasks, home).sortWithinPartitions(*keys, x, y)


def pairs_of(n: np.ndarray, pos: np.ndarray, side: np.ndarray, sk: np.ndarray, single: np.ndarray, label: np.ndarray, split: bool, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the candidate pairs among the groups that share one shingle (of one block or two), and by how many sketch bits they differ."""
    if split:
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j = np.repeat(a, len(b)), np.tile(b, len(a))
    else:
        i, j = np.triu_indices(len(n), 1)
    ni, nj = n[i], n[j]
    need = -(-percent * (ni + nj) // (100 + percent))
    fine = (100 * np.minimum(ni, nj) >= percent * np.maximum(ni, nj)) & (pos[i] <= ni - need) & (pos[j] <= nj - need) & (label[i] != label[j])
    i, j, most = i[fine], j[fine], (ni + nj - 2 * need)[fine]
    differ = np.bitwise_count(sk[i] ^ sk[j]).sum(axis=1)
    fine = (differ <= most) | ~(single[i] & single[j])
    return i[fine], j[fine], differ[fine]


def forest(i: np.ndarray, j: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Which of the pairs join what those before them (the least different ones first) leave apart."""
    root: dict[int, int] = {}

    def top(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    keep = []
    for k in np.argsort(differ, kind="stable").tolist():
        a, b = top(int(i[k])), top(int(j[k]))
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(k)
    return np.array(keep, np.int64)


def candidates(hits: DataFrame, percent: int, few: bool) -> DataFrame:
    """(a, b), a < b, of groups; hits come sorted by (token, x, y), each such key bounded.

    Pairs of one label aren't candidates: they are known to be connected. few: of the pairs of one key only a spanning forest.
    """

    def work(t: pa.Table, runs: list[tuple[int, int]]) -> pa.RecordBatch:
        x, y, block, gid, n, pos, single, label = (t.column(k).to_numpy() for k in ("x", "y", "block", "gid", "n", "pos", "single", "label"))
        sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
        left, right = [], []
        for s, e in runs:
            if e - s < 2 or (label[s:e] == label[s]).all():
                continue
            i, j, differ = pairs_of(n[s:e], pos[s:e], block[s:e] != x[s], sk[s:e], single[s:e] == 1, label[s:e], x[s] != y[s], percent)
            if few and len(i) > 1:
                keep = forest(i, j, differ)
                i, j = i[keep], j[keep]
            left.append(gid[s:e][i])
            right.append(gid[s:e][j])
        p = np.zeros((0, 2), np.int64)
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            p = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["a", "b"])

    return in_runs(hits, ["token", "x", "y"], work, "a long, b long")


def dealt_hits(hits: DataFrame, groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Hits (token, gid, n, pos, c) with their groups' sketches and labels, dealt by shingle; those of a
    shingle of many groups by pairs of blocks, so that each pair of groups meets in one task."""
    own = groups.select("gid", "sketch", (F.col("m") == 1).cast("int").alias("single"))
    rows = hits.join(own, "gid")
    if labels is None:
        rows = rows.withColumn("label", F.col("gid"))
    else:
        # groups of several classes have no one label
        rows = rows.join(labels.select(F.col("node").alias("gid"), "component"), "gid", "left").withColumn("label", F.when(F.col("single") == 1, F.coalesce("component", "gid")).otherwise(-F.col("gid") - 1))
    rows = rows.withColumn("parts", F.ceil(F.col("c") / BLOCK_GROUPS).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("gid"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "gid", "n", "pos", "single", "label", "sketch", "parts")
    return dealt(rows, ["token"], "x", "y", F.col("parts")).drop("parts")


def class_sets(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(cid, items): the whole sets of these classes (cid, rep, h1, h2), from the texts of their documents of least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for b in sliced(batches):
            out = []
            for cid, h1, h2, text in zip(*(c.to_pylist() for c in b.columns)):
                s = shingles.of(text)
                if set_key(s) == (h1, h2):  # another text of the same id is another class
                    out.append((cid, s.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["cid", "items"])

    wanted = classes.select("cid", F.col("rep").alias("doc_id"), "h1", "h2")
    found = docs.join(wanted, "doc_id").select("cid", "h1", "h2", "text").mapInArrow(run, "cid long, items binary")
    return found.groupBy("cid").agg(F.first("items").alias("items"))  # a repeated row gives its set once


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose whole sets are similar enough. Pairs are dealt in a square of
    blocks, so a set goes to no more than two rows of it; about SQUARE_BYTES of sets meet in a block."""
    size = pairs.count()
    mean = sets.agg(F.avg(F.length("items"))).first()[0] or 0
    side = max(LEAST_SIDE, math.isqrt(int(size * 2 * mean) // SQUARE_BYTES) + 1)
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(side)) * side + F.pmod(F.xxhash64("b"), F.lit(side)))
    need = pairs.select(F.col("block").alias("home"), F.explode(F.array("a", "b")).alias("cid")).distinct()

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = {i: np.frombuffer(x, np.uint64) for i, x in zip(right["cid"], right["items"])}
        keep = []
        for a, b in zip(left["a"], left["b"]):
            both = len(known[a]) + len(known[b])
            common = both - len(np.unique(np.concatenate([known[a], known[b]])))
            keep.append(100 * common >= percent * (both - common))
        return left.loc[keep, ["a", "b"]]

    return pairs.groupBy("block").cogroup(sets.join(need, "cid").groupBy("home")).applyInPandas(run, "a long, b long")


def links_of(items: list[bytes], side: np.ndarray, whole: bool, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, the later places linked with it): of all pairs (whole), or of those of one side with the other.

    Sets become rows of bits, one for each shingle that more than one of them has."""
    sets = [np.frombuffer(x, np.uint64) for x in items]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, which, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    place = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    kept = shared[which]
    at, owner = place[which[kept]], owner[kept]
    bits = np.zeros((len(sets), int(shared.sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    right = np.flatnonzero(side == 1)
    for i in range(len(sets)) if whole else np.flatnonzero(side == 0).tolist():
        j = np.arange(i + 1, len(sets)) if whole else right
        j = j[100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i])]
        common = np.bitwise_count(bits[j] & bits[i]).sum(axis=1, dtype=np.int64)
        yield i, j[100 * common >= percent * (sizes[j] + sizes[i] - common)]


def block_count(classes: str, shingles: str) -> Column:
    """Into how many blocks so many classes with so many shingles in all are cut."""
    n = F.col(classes)
    return F.greatest(F.least(F.ceil(n / BLOCK_CLASSES), F.lit(FEW_BLOCKS)), F.ceil(n / MOST_CLASSES), F.ceil(F.col(shingles) * 8 / BLOCK_BYTES), F.lit(1)).cast("int")


def in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (a, b, kind, cid, own, other) with their sets, dealt by pairs of blocks (x, y).

    kind 2: all pairs of the members of (a, b), cut into `own` blocks. kinds 0 and 1: those of one kind, cut
    into `own` blocks, with those of the other kind, cut into `other`."""
    z = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("own")).cast("int")
    rows = members.withColumn("z", z).withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == 2, F.col("own")).otherwise(F.col("other")) - 1)))
    same = F.col("kind") == 2
    x = F.when(same, F.least("z", "o")).when(F.col("kind") == 0, F.col("z")).otherwise(F.col("o"))
    y = F.when(same, F.greatest("z", "o")).when(F.col("kind") == 0, F.col("o")).otherwise(F.col("z"))
    rows = rows.withColumns({"x": x, "y": y, "side": F.when(same, (F.col("z") != x).cast("int")).otherwise(F.col("kind"))})
    rows = rows.withColumn("whole", (same & (F.col("x") == F.col("y"))).cast("int")).withColumn("width", F.when(F.col("kind") == 0, F.col("other")).otherwise(F.col("own")))
    rows = rows.join(sets, "cid").select("a", "b", "x", "y", "side", "whole", "cid", "width", "items")
    return dealt(rows, ["a", "b"], "x", "y", F.col("width")).drop("width")


def member_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the members, of every pair of blocks only a spanning forest."""

    def work(t: pa.Table, runs: list[tuple[int, int]]) -> pa.RecordBatch:
        cid, side, whole, items = t.column("cid").to_numpy(), t.column("side").to_numpy(), t.column("whole").to_numpy(), t.column("items").to_pylist()
        out: list[tuple[int, int]] = []
        for s, e in runs:
            if e - s > 1:
                for i, j in links_of(items[s:e], side[s:e], bool(whole[s]), percent):
                    out += [(int(cid[s + i]), int(cid[s + k])) for k in j]
                out = [(root, v) for root, v in stars(out) if root != v] if len(out) > UNION_LINKS else out
        out = [(root, v) for root, v in stars(out) if root != v]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    return in_runs(in_blocks(members, sets), ["a", "b", "x", "y"], work, "a long, b long")


def link_counts(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cid, n_links) of the members of components; links are counted where blocks meet, not listed."""

    def work(t: pa.Table, runs: list[tuple[int, int]]) -> pa.RecordBatch:
        cid, side, whole, items = t.column("cid").to_numpy(), t.column("side").to_numpy(), t.column("whole").to_numpy(), t.column("items").to_pylist()
        n = np.zeros(len(cid), np.int64)
        for s, e in runs:
            if e - s > 1:
                for i, j in links_of(items[s:e], side[s:e], bool(whole[s]), percent):
                    n[s + i] += len(j)
                    n[s + j] += 1
        return pa.RecordBatch.from_arrays([pa.array(cid[n > 0]), pa.array(n[n > 0])], ["cid", "found"])

    found = in_runs(in_blocks(members, sets), ["a", "b", "x", "y"], work, "cid long, found long")
    return found.groupBy("cid").agg(F.sum("found").alias("n_links"))


def stars(links) -> Iterator[tuple[int, int]]:
    """(least connected node, node) for every node of these links."""
    root: dict[int, int] = {}

    def top(v: int) -> int:
        while (up := root.setdefault(v, v)) != v:
            root[v] = v = root[up]
        return v

    for x, y in links:
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return ((top(v), v) for v in list(root))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b), for every linked node.

    Each task first replaces its links, UNION_LINKS at a time, by stars of the same components. Then rounds
    take the least label among neighbours and the label of a node's label; a table in the shared folder ends
    each round, and only a count comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            made = [(root, v) for root, v in stars(held) if root != v]
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in made], pa.int64()), pa.array([b for _, b in made], pa.int64())], ["a", "b"])

        for batch in batches:
            for part in sliced([batch], UNION_LINKS, 1 << 30):
                held += zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                if len(held) >= UNION_LINKS:
                    yield out()
                    held = []
        yield out()

    least = links.mapInArrow(run, "a long, b long")
    both = staged(least.unionByName(least.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("m")).withColumnRenamed("a", "node")
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        now = labels.join(near, "node").join(up, "component").select("node", F.col("component").alias("old"), F.least("component", "m", "up").alias("component"))
        now = staged(now, "labels")
        release(labels)
        labels = now.select("node", "component")
        labels._staged_at = now._staged_at
        if now.filter("component <> old").isEmpty():
            release(both)
            return labels


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (to classes of other sets), text_hash (xxhash64 of the text)
    and group_id (a number of the row's class and all classes linked with it, directly or not) of every row.

    Rows link when 100 |A and B| >= percent |A or B|. Null and empty texts and texts without words
    have no shingles and link with nothing. A null id links with nothing and has neither component nor
    group. Equal rows and rows of equal sets are one class. Rows that share an id are one node of the
    graph of ids, whatever their texts: their component is that of the id, which joins the components of
    its classes. group_id goes by links alone, so texts of one id are together only if they link; rows
    without shingles have none. Texts of any length are taken whole. No rows give none; other columns are
    ignored.
    """
    if not 0 < percent <= 100 or n < 1:
        raise ValueError("percent must be 1 to 100 and n at least 1")
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bits = min(MOST_BITS, max(LEAST_BITS, estimated_bytes(rows).bit_length() - 1))
    shape = staged(shapes(rows, n, bits), "shapes")
    often = np.minimum(sum_blocks(shape.filter("block IS NOT NULL"), 1 << bits, SLOT_BLOCK), 2**31 - 1).astype(np.int32)
    counts = spark.sparkContext.broadcast(often)  # 4 bytes a slot, 16 MB at most
    shape = shape.filter("block IS NULL").select("doc_id", "text_hash", "n", "h1", "h2")
    found = prefixes(rows.filter("doc_id IS NOT NULL"), n, percent, bits, counts)
    classes = found.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("prefix", "p1", "p2", "sketch")])
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    counts.destroy()
    groups = classes.groupBy("n", "p1", "p2").agg(F.min("cid").alias("gid"), F.count("*").alias("m"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
    groups = staged(groups, "groups")
    large = groups.filter("m > 1").select("n", "p1", "p2", "gid", "m")
    sized = large.withColumn("all", F.col("m") * F.col("n"))
    members = staged(classes.select("n", "p1", "p2", "cid").join(sized, ["n", "p1", "p2"]).select("gid", "cid", block_count("m", "all").alias("own")), "members")

    tokens = groups.select("gid", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    shared = tokens.groupBy("token").agg(F.count("*").cast("int").alias("c")).filter("c > 1")
    hits = staged(tokens.join(shared, "token"), "hits")

    first = staged(candidates(dealt_hits(hits, groups, None), percent, True).distinct(), "candidates")
    met = first.select(F.explode(F.array("a", "b")).alias("gid")).unionByName(members.select("gid")).distinct()
    need = met.join(members.select("gid", "cid"), "gid", "left").select(F.coalesce("cid", "gid").alias("cid"))
    sets = staged(class_sets(rows, classes.select("cid", "rep", "h1", "h2").join(need, "cid"), n), "sets")
    within = large.select(F.col("gid").alias("a"), F.col("gid").alias("b"))

    def tried(pairs: DataFrame) -> DataFrame:
        """The links that verifying these pairs of groups gives."""
        many = large.select("gid")
        some = pairs.join(many.select(F.col("gid").alias("a"), F.lit(1).alias("ma")), "a", "left").join(many.select(F.col("gid").alias("b"), F.lit(1).alias("mb")), "b", "left")
        some = staged(some.select("a", "b", (F.coalesce("ma", "mb").isNotNull()).alias("expand")), "pairs")
        single = verified(some.filter("NOT expand").select("a", "b"), sets, percent)
        mixed = some.filter("expand").select("a", "b")
        size = members.groupBy("gid").agg(F.first("own").alias("parts"))
        mixed = mixed.join(size.select(F.col("gid").alias("a"), F.col("parts").alias("pa")), "a", "left").join(size.select(F.col("gid").alias("b"), F.col("parts").alias("pb")), "b", "left").fillna(1, ["pa", "pb"])

        def side(kind: int, gid: str, own: str, other: str) -> DataFrame:
            those = mixed.filter("a <> b").select("a", "b", F.lit(kind).alias("kind"), F.col(gid).alias("gid"), F.col(own).alias("own"), F.col(other).alias("other"))
            return those.join(members.select("gid", "cid"), "gid", "left").select("a", "b", "kind", F.coalesce("cid", "gid").alias("cid"), "own", "other")

        inside = mixed.filter("a = b").join(members.select(F.col("gid").alias("a"), "cid"), "a").select("a", "b", F.lit(2).alias("kind"), "cid", F.col("pa").alias("own"), F.lit(1).alias("other"))
        expanded = side(0, "a", "pa", "pb").unionByName(side(1, "b", "pb", "pa")).unionByName(inside)
        return single.unionByName(member_links(expanded, sets, percent))

    links = staged(tried(first.unionByName(within)), "verified")
    reps = components(links)
    rest = staged(candidates(dealt_hits(hits.filter("c > 2"), groups, reps), percent, False).distinct().join(first, ["a", "b"], "left_anti"), "candidates")
    if not rest.isEmpty():
        links = staged(links.unionByName(tried(rest)), "verified")
        reps = components(links)
    release(hits, first, rest)

    sized = reps.join(classes.select(F.col("cid").alias("node"), "n", "rep"), "node")
    whole = sized.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("all")).select("component", "k", block_count("k", "all").alias("own"))
    placed = staged(reps.join(whole, "component").select(F.col("node").alias("cid"), "component", "k", "own"), "in-components")
    alike = placed.filter("k > 2").select(F.col("component").alias("a"), F.col("component").alias("b"), F.lit(2).alias("kind"), "cid", "own", F.lit(1).alias("other"))
    degree = placed.filter("k = 2").select("cid", F.lit(1).cast("long").alias("n_links")).unionByName(link_counts(alike, sets, percent))
    degree = staged(degree, "degrees")
    release(sets, members, groups)

    # an id of several texts joins the components of their classes
    key = F.struct("n", "h1", "h2")
    again = shape.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo <> hi").select("doc_id")
    again = staged(again, "repeated-ids")
    of_ids = shape.join(again, "doc_id").join(classes.select("h1", "h2", "n", "cid"), ["h1", "h2", "n"]).select("doc_id", "cid").distinct()
    of_ids = staged(of_ids, "classes-of-ids")
    final = reps
    if not of_ids.isEmpty():
        least = of_ids.groupBy("doc_id").agg(F.min("cid").alias("a"))
        final = components(links.unionByName(of_ids.join(least, "doc_id").filter("a <> cid").select("a", F.col("cid").alias("b"))))
    named = final.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select(F.col("node").alias("cid"), "component_id")
    special = classes.select("h1", "h2", "n", "rep", "copies", "cid").join(named, "cid", "left").join(degree, "cid", "left").join(reps.select(F.col("node").alias("cid"), "component"), "cid", "left")
    special = special.select("h1", "h2", "n", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "cid").alias("group_id"), "cid")
    special = staged(special, "components")  # of known size: broadcast only if small, else joined with skewed classes split
    by_id = of_ids.join(special.select("cid", "component_id"), "cid").groupBy("doc_id").agg(F.min("component_id").alias("id_component"))
    out = shape.join(special.drop("cid"), ["h1", "h2", "n"], "left").join(staged(by_id, "components-of-ids"), "doc_id", "left")
    there = lambda c: F.when(F.col("doc_id").isNotNull(), c)
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), there(F.coalesce("component_id", "id_component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"), "text_hash", there(F.col("group_id")).alias("group_id"),
    )
