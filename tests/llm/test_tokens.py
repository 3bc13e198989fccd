"""Packing, byte-level BPE and token files against the libraries."""

import base64
import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from terralot.llm.bpe import encode_decode, encode_match, load_ranks
from terralot.llm.packing import pack, served, windows_of
from terralot.llm.token_store import DacFile, dac_bytes, read_tokens, write_tokens
from terralot.llm.tokens import library_encoder

from .conftest import ROWS

RANKS = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
BPE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts():
    r = random.Random(4)
    odd = ["a  b", "a\n b", " a", "\n", "é  b", "a\u3000b c", "x\x1c y", "tab\t end\t", "it's I'LL", "١٢٣ 12a", "a\r\nb ", "  ", "a   b", "end.", "Ünï, cödé!? a*** b$$$.", "ª º µ."]
    return odd + ["".join(r.choice("ab é\n ,.1'日 ") for _ in range(r.randrange(60))) for _ in range(300)]


def test_chunks_give_the_library_ids(library):
    encoder = library_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for some in (texts(), texts()[::-1], [None, "", *texts()[:3]], ["x" * 5000, "ab " + "y" * 200 + ". z", " lead", "trail ", "a\0b c\0. d.\0e"], []):
        ids, bounds = encoder.encode(pa.array(some, pa.string()))
        assert [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:])] == [library(t) for t in some]


def test_encoder_forgets(library):
    r = random.Random(8)
    encoder = library_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.forget()
    encoder.entries, before = 50, encoder.entries
    for _ in range(6):
        some = [" ".join("".join(r.choice("abcdé.,1") for _ in range(r.randrange(1, 9))) for _ in range(80)) for _ in range(3)]
        ids, bounds = encoder.encode(pa.array(some))
        assert [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:])] == [library(t) for t in some]
    encoder.entries = before


def test_other_vocabularies_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, bounds = library_encoder(path).encode(pa.array(["A plain text.", "", "two  words"]))
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    assert [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:])] == [t.encode(x, add_special_tokens=False).ids for x in ("A plain text.", "", "two  words")]


def test_matches_merge_as_the_library_does():
    r = random.Random(5)
    pieces = ["".join(r.choice("abcdeé the") for _ in range(n)).encode() for n in (*range(1, 60), 3000)] + [b"a" * 5000, bytes(range(256))]
    for p in pieces:
        assert encode_match(p, RANKS) == BPE._encode_single_piece(p)


def test_bpe(spark, edge, none):
    rows = encode_decode(edge, with_ids=True).collect()
    assert len(rows) == len(ROWS)
    want = defaultdict(list)
    for i, t, _ in ROWS:
        ids = BPE.encode_ordinary(t or "")
        want[i].append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in want[r["doc_id"]]
    assert encode_decode(none).count() == 0
    assert base64.b64decode(b"YQ==") in RANKS


def test_windows():
    assert list(windows_of(2048 + 700, 1024)) == [1024, 1024, 512, 128, 32, 16, 8, 4]
    assert list(windows_of(0, 1024)) == []


def distance(got, shares):
    """Total variation of a window's tokens from the mixture."""
    return 0.5 * np.abs(got / got.sum() - shares).sum()


@pytest.mark.parametrize("shares", [[0.7, 0.2, 0.1], [1 / 20] * 20, [1 / 3] + [2 / 57] * 19])
def test_every_window_holds_the_mixture(shares):
    shares = np.array(shares)
    queues = np.round(shares * 40 * 1024).astype(np.int64)
    sizes = list(windows_of(int(queues.sum()), 1024))
    got = served(queues, shares, np.zeros(len(shares)), sizes, 16)
    assert got.sum(axis=0).tolist() == queues.tolist() and got.sum(axis=1).tolist() == sizes
    full = got[:39]
    assert max(distance(x, shares) for x in full) <= 0.5 * len(shares) / 1024 + 1e-9
    owed = np.cumsum(np.array([1024 * shares] * len(full)) - full, axis=0)
    assert np.abs(owed).max() < 2  # what a window owes the next ones pay


def test_round_robin_by_brute_force():
    """The same rounds, token by token: who is owed most (and a piece at least) gets the next token."""
    r = random.Random(7)
    for _ in range(30):
        n = r.randrange(2, 7)
        shares = np.array([r.random() + 0.05 for _ in range(n)])
        shares /= shares.sum()
        queues = np.array([r.randrange(300, 900) for _ in range(n)])
        sizes = list(windows_of(int(queues.sum()), 128))
        got = served(queues, shares, np.zeros(n), sizes, 1)
        left, owed = queues.astype(float), np.zeros(n)
        for row, size in zip(got, sizes):
            share = np.where(left > 0, shares, 0)
            owed += size * share / share.sum()
            owed[left == 0] = 0
            fill, scale = np.zeros(n), np.maximum(owed, 0) / np.maximum(owed, 0).sum() * size
            while fill.sum() < size:
                fill[np.argmax(np.where(fill < left, scale - fill, -np.inf))] += 1
            if (scale <= left).all():
                assert np.abs(fill - row).max() <= 1
            left, owed = left - row, owed - row


def test_small_sources_wait():
    shares = np.array([0.99, 0.01])
    got = served(np.array([99_000, 1000]), shares, np.zeros(2), list(windows_of(100_000, 1024)), 16)
    parts = got[:, 1][got[:, 1] > 0]
    assert parts[:-3].min() >= 15 and got.sum(axis=0).tolist() == [99_000, 1000]


def test_deficits_are_carried():
    first = served(np.array([900, 900]), np.array([0.5, 0.5]), np.array([-300.0, 300.0]), [1024, 512], 16)[0]
    assert first.tolist() == [212, 812]


@pytest.mark.parametrize("bucket", [200, 131_072])
def test_packing(spark, edge, none, library, bucket):
    rows = [r for r in pack(edge, bucket_tokens=bucket, with_ids=True).collect()]
    by = defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        by[r["doc_id"]].append(r)
    for i in {r[0] for r in ROWS}:
        want = sorted([*library(t), 0] for j, t, _ in ROWS if j == i)
        pieces = sorted((r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist()) for r in by[i])
        assert sum(n for _, n, _ in pieces) == sum(map(len, want))
        if len(want) == 1:
            assert sum((p for _, _, p in pieces), []) == want[0] and by[i][0]["doc_tokens"] == len(want[0])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 1024 or at & (at - 1) == 0
    assert pack(none).count() == 0
    assert pack(edge, weights={"a": 3.0, "b": 1.0}).count() > 0


@pytest.mark.parametrize("weights", [None, {"a": 2.0, "b": 1.0, "c": 1.0}])
def test_mixture_holds_in_every_bucket(spark, weights):
    """One long document of a source and many short ones of others, cut at buckets of four windows."""
    rows = [(1, "word " * 20_000, "a")] + [(10 + i, f"a short line {i} " * 20, "bc"[i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = pack(docs, weights=weights, bucket_tokens=4096).collect()
    of_source, of_window, where = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for r in got:
        of_source[r["source"]] += r["length"]
        of_window[r["sequence_id"]][r["source"]] += r["length"]
        where[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for pieces in where.values():
        ends = [0] + [a + n for a, n, _ in sorted(pieces)]
        assert [a for a, _, _ in sorted(pieces)] == ends[:-1] and ends[-1] == pieces[0][2]
    total = sum(of_source.values())
    want = {k: n / total for k, n in of_source.items()} if weights is None else {k: w / 4 for k, w in weights.items()}
    lasting = min(of_source[k] / want[k] for k in want)  # as long as no source has run out
    seen = off = 0
    for _, w in sorted(of_window.items()):
        n = sum(w.values())
        if seen + n > lasting:
            break
        seen += n
        if n == 1024 and sum(abs(w[k] / n - want[k]) for k in want) / 2 > 0.01:
            off += n
    assert seen > 20_000 and off < 0.05 * seen
    assert max(s >> 32 for s in of_window) >= total // 4096 - 1


def test_codes():
    r = np.random.default_rng(1)
    ids = np.concatenate([r.integers(0, 256, 3000), r.integers(0, 70_000, 3000), [0, 255, 256, 65535, 65536, 2**32 - 1]]).astype("<u4")
    r.shuffle(ids)
    import tempfile

    with tempfile.NamedTemporaryFile(suffix=".dac") as f:
        f.write(dac_bytes(ids, np.array([3, -(1 << 63)]), np.array([0, 10, len(ids)])))
        f.flush()
        d = DacFile(f.name)
        assert d.tokens(0, len(ids)).tolist() == ids.tolist() and d.tokens(517, 1999).tolist() == ids[517:1999].tolist() and d.tokens(5, 5).tolist() == []
        assert [d.token(i) for i in range(0, len(ids), 37)] == ids[::37].tolist()


@pytest.mark.parametrize("size", [20, 2_000_000])
def test_token_files(spark, edge, none, library, size):
    rows = read_tokens(write_tokens(edge, file_tokens=size), with_ids=True).collect()
    want = sorted(((i is not None, i or 0, [*library(t), 2]) for i, t, _ in ROWS), key=lambda x: x[:2])
    at, places = 0, {}
    for known, i, ids in want:
        places.setdefault(i if known else None, []).append((at, len(ids)))
        at += len(ids)
    assert len(rows) == len(ROWS) and sorted(r["start"] for r in rows) == sorted(a for v in places.values() for a, _ in v)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["ids"] in [[*library(t), 2] for i, t, _ in ROWS if i == r["doc_id"]]
    assert read_tokens(write_tokens(none)).count() == 0


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("weighted", [False, True])
def test_mixture_of_the_test_tables(spark, weighted):
    """Mean distance of full windows from the mixture, over all documents, and no window of one source while others have tokens."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = sorted(r["source"] for r in docs.select("source").distinct().collect())
    weights = {k: 1.0 + i % 3 for i, k in enumerate(names)} if weighted else None
    rows = pack(docs, weights=weights, bucket_tokens=1 << 17).toPandas()
    of_source = rows.groupby("source")["length"].sum()
    want = of_source / of_source.sum() if weights is None else pd.Series(weights) / sum(weights.values())
    lasting = (of_source / want).min()
    got = rows.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0).sort_index()
    full = got[(got.sum(axis=1) == 1024) & (got.sum(axis=1).cumsum() <= lasting)]
    off = (full / 1024 - want).abs().sum(axis=1) / 2
    assert len(full) > 100 and off.mean() <= 0.02 and off.max() <= 0.2 and (full > 0).sum(axis=1).min() > 1
