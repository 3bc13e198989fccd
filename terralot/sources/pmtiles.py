"""PMTiles v3 archives as a Spark data source.

spark.read.format("pmtiles").load(path): z, x, y, tile_id, data; equality filters on z, x and y become
look-ups in the directories. Option mode=directory gives z, x, y, tile_id, offset, length without data.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

from ..functions.mvt import Reader, varint
from .shared import new_folder, open_read, open_write, remove

#: Fixed values of the format: magic, length of the header, its layout, gzip and vector tile codes.
MAGIC, HEADER_BYTES, LAYOUT, GZIP, MVT = b"PMTiles", 127, "<7sB11Q6B4iBii", 2, 1


def tile_id(z: int, x: int, y: int) -> int:
    """Place of a tile on the Hilbert curves of all levels, one after the other."""
    base = (4**z - 1) // 3
    d, s = 0, 1 << z >> 1
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * (3 * rx ^ ry)
        if not ry:
            if rx:
                x, y = s - 1 - (x & s - 1), s - 1 - (y & s - 1)
            x, y = y, x
        s >>= 1
    return base + d


def tile_number(z: Column, x: Column, y: Column) -> Column:
    """tile_id as an expression: level by level from the top, with x and y turned as the curve turns."""
    shift = lambda v, k: F.call_function("shiftright", v, k).bitwiseAND(F.lit(1))
    long = lambda c: c.cast("long")

    def step(s: Column, k: Column) -> Column:
        rx, ry = shift(s["x"], k), shift(s["y"], k)
        side = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        low = lambda v: v.bitwiseAND(side - 1)
        turned = lambda v: F.when(rx == 1, side - 1 - low(v)).otherwise(low(v))
        d = s["d"] + side * side * (rx * 3).bitwiseXOR(ry)
        return F.struct(d.alias("d"), F.when(ry == 0, turned(s["y"])).otherwise(low(s["x"])).alias("x"), F.when(ry == 0, turned(s["x"])).otherwise(low(s["y"])).alias("y"))

    steps = F.when(z > 0, F.sequence(z - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.lit(0).cast("long").alias("d"), long(x).alias("x"), long(y).alias("y"))
    base = (F.call_function("shiftleft", F.lit(1).cast("long"), z * 2) - 1) / 3
    return long(base) + F.aggregate(steps, start, step, lambda s: s["d"])


def tile_place(number: int) -> tuple[int, int, int]:
    z = 0
    while number >= 4**z:
        number -= 4**z
        z += 1
    x = y = 0
    s = 1
    while s < 1 << z:
        rx = 1 & number // 2
        ry = 1 & (number ^ rx)
        if not ry:
            if rx:
                x, y = s - 1 - x, s - 1 - y
            x, y = y, x
        x, y = x + s * rx, y + s * ry
        number //= 4
        s *= 2
    return z, x, y


Entry = tuple[int, int, int, int]  # tile id, run length (0: a leaf directory), length, offset


def encode_directory(entries: list[Entry]) -> bytes:
    out = bytearray(varint(len(entries)))
    last = 0
    for e in entries:
        out += varint(e[0] - last)
        last = e[0]
    for e in entries:
        out += varint(e[1])
    for e in entries:
        out += varint(e[2])
    end = -1
    for e in entries:
        out += varint(0 if e[3] == end else e[3] + 1)
        end = e[3] + e[2]
    return bytes(out)


def parse_directory(data: bytes) -> list[Entry]:
    r = Reader(data)
    n = r.varint()
    ids, last = [], 0
    for _ in range(n):
        last += r.varint()
        ids.append(last)
    runs = [r.varint() for _ in range(n)]
    lengths = [r.varint() for _ in range(n)]
    offsets: list[int] = []
    for i in range(n):
        v = r.varint()
        offsets.append(v - 1 if v else offsets[-1] + lengths[i - 1])
    return list(zip(ids, runs, lengths, offsets))


class Archive:
    def __init__(self, path: str):
        self.file = open_read(path)
        head = struct.unpack(LAYOUT, self.file.read(struct.calcsize(LAYOUT)))
        if head[0] != MAGIC or head[1] != 3:
            raise ValueError(f"no PMTiles archive of version 3: {path}")
        self.root, self.meta, self.leaves, self.data = ((head[i], head[i + 1]) for i in (2, 4, 6, 8))
        self.internal, self.minzoom, self.maxzoom = head[14], head[17], head[18]

    def bytes_at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def directory(self, start: int, length: int) -> list[Entry]:
        raw = self.bytes_at(start, length)
        return parse_directory(gzip.decompress(raw) if self.internal == GZIP else raw)

    def metadata(self) -> dict:
        raw = self.bytes_at(*self.meta)
        return json.loads(gzip.decompress(raw) if self.internal == GZIP else raw or b"{}")

    def entries(self, start: int | None = None, length: int | None = None) -> Iterator[Entry]:
        """Every tile entry, leaf directories opened."""
        for e in self.directory(*(self.root if start is None else (start, length))):
            if e[1]:
                yield e
            else:
                yield from self.entries(self.leaves[0] + e[3], e[2])

    def find(self, number: int) -> tuple[int, int] | None:
        """(offset, length) in the data section of one tile."""
        at = self.root
        for _ in range(4):
            entries = self.directory(*at)
            i = bisect_right(entries, (number, float("inf"))) - 1
            if i < 0:
                return None
            e = entries[i]
            if e[1]:
                return (e[3], e[2]) if number < e[0] + e[1] else None
            at = (self.leaves[0] + e[3], e[2])
        return None


def write_archive(tiles: DataFrame, uri: str, metadata: dict | None = None, leaf_entries: int = 4096) -> dict:
    """Write tiles (z, x, y, data) as one archive file, gzip-compressed; equal neighbours share their bytes and
    one entry. Tasks write their ranges of tile ids as parts in the shared folder; the driver gets the directory's
    entries and puts the parts together."""
    parts = new_folder(tiles.sparkSession, "tile-parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out, at, last, entries = f"{parts}/{uuid.uuid4().hex}", None, 0, b"", []
        for b in batches:
            for number, z, data in zip(*(c.to_pylist() for c in b.columns)):
                data = data if data[:2] == b"\x1f\x8b" else gzip.compress(data, mtime=0)
                out = out or open_write(uri)
                if entries and data == last and entries[-1][0] + entries[-1][1] == number:
                    entries[-1][1] += 1
                    continue
                entries.append([number, 1, len(data), at, z])
                out.write(data)
                at, last = at + len(data), data
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([entries[0][0]]), pa.array([at]), pa.array([json.dumps(entries)])], ["uri", "first", "bytes", "entries"])

    rows = tiles.select(tile_number(F.col("z"), F.col("x"), F.col("y")).alias("id"), "z", "data").repartitionByRange("id").sortWithinPartitions("id")
    made = rows.mapInArrow(run, "uri string, first long, bytes long, entries string").collect()  # the directory, which goes into the file's head
    entries: list[list[int]] = []
    at, n, zooms = 0, 0, []
    made.sort(key=lambda r: r["first"])
    for r in made:
        for number, run_length, length, offset, z in json.loads(r["entries"]):
            entries.append([number, run_length, length, at + offset])
            n, zooms = n + run_length, zooms + [z] if not zooms or zooms[-1] != z else zooms
        at += r["bytes"]
    pack = lambda e: gzip.compress(encode_directory([tuple(x) for x in e]), mtime=0)
    leaves, root = b"", entries
    if len(entries) > leaf_entries:
        root = []
        for i in range(0, len(entries), leaf_entries):
            leaf = pack(entries[i : i + leaf_entries])
            root.append([entries[i][0], 0, len(leaf), len(leaves)])
            leaves += leaf
    top, meta = pack(root), gzip.compress(json.dumps(metadata or {}).encode(), mtime=0)
    places = [HEADER_BYTES, len(top), HEADER_BYTES + len(top), len(meta), HEADER_BYTES + len(top) + len(meta), len(leaves), HEADER_BYTES + len(top) + len(meta) + len(leaves), at]
    lowest, deepest = (min(zooms), max(zooms)) if n else (0, 0)
    head = struct.pack(LAYOUT, MAGIC, 3, *places, n, len(entries), len(entries), 1, GZIP, GZIP, MVT, lowest, deepest, -1800000000, -850000000, 1800000000, 850000000, lowest, 0, 0)
    with open_write(uri) as f:
        for part in (head, top, meta, leaves):
            f.write(part)
        for r in made:
            with open_read(r["uri"]) as b:
                while chunk := b.read(1 << 20):
                    f.write(chunk)
    remove(tiles.sparkSession, parts)
    return {"tiles": n, "entries": len(entries), "bytes": at}


class PMTiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pmtiles"

    def schema(self) -> str:
        rest = "offset long, length long" if self.options.get("mode") == "directory" else "data binary"
        return f"z int, x int, y int, tile_id long, {rest}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    STEP = 20_000

    def __init__(self, options: dict):
        self.path, self.places = options["path"], options.get("mode") == "directory"
        self.wanted: dict[str, set[int]] = {}

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute[0] in "zxy":
                self._want(f.attribute[0], {f.value})
            elif isinstance(f, In) and f.attribute[0] in "zxy":
                self._want(f.attribute[0], set(f.value))
            yield f  # Spark tests every row again

    def _want(self, name: str, values: set) -> None:
        self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> list[InputPartition]:
        """Look-ups if z, x and y are all given; else a partition for each leaf directory that may hold a wanted
        level, and for every STEP entries of the root."""
        w = self.wanted
        if len(w) == 3 and len(w["z"]) * len(w["x"]) * len(w["y"]) <= self.STEP:
            return [InputPartition([(z, x, y) for z in w["z"] for x in w["x"] for y in w["y"] if 0 <= z <= 31 and 0 <= x < 2**z and 0 <= y < 2**z])]
        a = Archive(self.path)
        root = a.directory(*a.root)
        out = []
        for e, after in zip(root, [*(e[0] for e in root[1:]), 4**32]):
            if not e[1] and self._may_hold(e[0], after):
                out.append(InputPartition((a.leaves[0] + e[3], e[2], 0, None)))
        tiles = sum(1 for e in root if e[1])
        return out + [InputPartition((*a.root, i, i + self.STEP)) for i in range(0, tiles, self.STEP)] or [InputPartition([])]

    def _may_hold(self, first: int, after: int) -> bool:
        zooms = self.wanted.get("z")
        return zooms is None or any(first < (4 ** (z + 1) - 1) // 3 and after > (4**z - 1) // 3 for z in zooms)

    def read(self, partition: InputPartition):
        a = Archive(self.path)
        row = lambda number, off, n: (*tile_place(number), number, *((a.data[0] + off, n) if self.places else (a.bytes_at(a.data[0] + off, n),)))
        if isinstance(partition.value, list):
            for z, x, y in partition.value:
                number = tile_id(z, x, y)
                if found := a.find(number):
                    yield row(number, *found)
            return
        start, length, first, end = partition.value
        entries = a.entries(start, length) if end is None else [e for e in a.directory(start, length) if e[1]][first:end]
        for number, run, length, offset in entries:
            for k in range(run):
                if self._may_hold(number + k, number + k + 1):
                    yield row(number + k, offset, length)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with look-ups by filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PMTiles)


def load_index(spark: SparkSession, uri: str) -> DataFrame:
    """(z, x, y, tile_id, offset, length) of every tile, kept in memory for look-ups."""
    return spark.read.format("pmtiles").option("mode", "directory").load(uri).cache()


def tile_lookup(requests: DataFrame, index: DataFrame) -> DataFrame:
    """Requests (z, x, y, ...) with offset and length of their tiles; null where there is none."""
    return requests.join(index.select("z", "x", "y", "offset", "length"), ["z", "x", "y"], "left")


def index_stats(directory: DataFrame) -> DataFrame:
    """(z, tiles, bytes, most_bytes) of each level."""
    return directory.groupBy("z").agg(F.count("*").alias("tiles"), F.sum("length").cast("long").alias("bytes"), F.max("length").cast("long").alias("most_bytes"))


def densest(directory: DataFrame) -> DataFrame:
    """(z, x, y) of each level's largest tile; of equal ones the first by (x, y)."""
    return directory.groupBy("z").agg(F.min_by(F.struct("x", "y"), F.struct(-F.col("length"), "x", "y")).alias("t")).select("z", "t.x", "t.y")


def index_document(directory: DataFrame) -> DataFrame:
    """One JSON document per level: stats and tiles[x][y] = {offset, length}. directory: z, x, y, offset, length."""
    cell = directory.groupBy("z", "x").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("y").cast("string").alias("k"), F.struct("offset", "length").alias("v"))))).alias("ys"))
    level = cell.groupBy("z").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("x").cast("string").alias("k"), F.to_json("ys").alias("v"))))).alias("xs"))
    inner = F.transform(F.map_entries("xs"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    numbers = F.to_json(F.struct("tiles", "bytes", "most_bytes"))
    return level.join(index_stats(directory), "z").select("z", F.concat(F.lit('{"stats":'), numbers, F.lit(',"tiles":{'), F.array_join(inner, ","), F.lit("}}")).alias("doc"))
