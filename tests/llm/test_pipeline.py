"""The pipeline's stages, alone and together."""

import collections
import itertools
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terralot.llm.packing import pack
from terralot.llm.quality_crf import fit_quality, scores_of

from .conftest import ROWS
from .test_texts import corpus, counted, prose, similar


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good documents, bad ones, copies, and rows of every odd kind."""
    at = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, prose(random.Random(i), 60) + "\n" + t, "en", f"s{i % 3}", len(t)) for i, t, _, _ in corpus(150)]
    rows += [(1000 + i, r[1], "en", "s0", r[4]) for i, r in enumerate(rows[:40])]
    rows += [(i, t, "en", s, len(t or "")) for i, t, s in [(None if i is None else 5000 + i, t, s) for i, t, s in ROWS]] + rows[:3]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, q, x) for i, _, q, x in corpus(150)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "packing"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], folder)
        assert out.columns == docs.columns
        seen.append(spark.createDataFrame(out.collect(), docs.schema))
    counts = [d.count() for d in seen]
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0
    kept = [r["doc_id"] for r in seen[-1].collect()]
    assert len(set(kept)) == len(kept)
    before = {r["doc_id"] for r in seen[-2].collect()}
    assert not [i for i in kept if i is not None and 1000 <= i < 1040 and i - 1000 in before]  # copies go, the least id stays
    good = {i for i, _, q, _ in corpus(150) if q}
    assert len(good & set(kept)) > 0.95 * len(good)
    assert len({i for i, _, q, _ in corpus(150) if not q} & set(kept)) < 0.2 * (150 - len(good))
    want = collections.Counter(r["ids_crc32"] for r in pack(seen[-1]).collect())
    assert want == collections.Counter(r["ids_crc32"] for r in corpus_pipeline.run(spark, folder).collect())


def test_against_brute_force(spark, folder):
    """Every stage over again in plain Python: which rows stay, and where their tokens lie."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}

    fails = collections.defaultdict(list)
    bad = []
    for _, t, s in rows:
        n, *_, again = counted(t)
        bad.append(n < 50 or 100 * again > 50 * n)
        fails[s].append(bad[-1])
    rates = [np.mean(v) for s, v in fails.items() if s is not None]
    m, v = np.mean(rates), np.var(rates)
    k = max(m * (1 - m) / v - 1, 0)
    rows = [r for r, b in zip(rows, bad) if not b and (r[2] is None or (sum(fails[r[2]]) + m * k) / (len(fails[r[2]]) + k) < 0.5)]

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = fit_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"), labels)
    rows = [r for r, score in zip(rows, scores_of([t for _, t, _ in rows], model)[0]) if score >= 0.7]

    made, _, group, _ = similar([r[:2] for r in rows], 5, 80)
    least = {}
    for (i, t, _), s in zip(rows, made):
        if i is not None and s:
            least[group[s]] = min(least.get(group[s], (i, hashes[t])), (i, hashes[t]))
    kept, seen = [], set()
    for (i, t, source), s in zip(rows, made):
        if i is None or ((not s or least[group[s]] == (i, hashes[t])) and (i, t) not in seen):
            kept.append((i, t, source))
            seen.add((i, t))

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode.encode_special_tokens = True
    want = collections.defaultdict(list)
    for i, t, _ in kept:
        want[i].append([*encode.encode(t or "", add_special_tokens=False).ids, 0])
    got, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == want.keys() and len(want) > 50
    for i, pieces in got.items():
        assert sum(n for _, n, _, _ in pieces) == sum(map(len, want[i]))
        if len(want[i]) == 1:
            at = 0
            for start, n, crc, whole in sorted(pieces):
                assert start == at and whole == len(want[i][0]) and crc == zlib.crc32(np.array(want[i][0][start : start + n], "<u4").tobytes())
                at += n
    for pieces in windows.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(pieces))]
        assert [a for a, _ in sorted(pieces)] == ends[:-1] and (ends[-1] == 1024 or ends[-1] & (ends[-1] - 1) == 0)


def test_near_duplicates_lose_no_text(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    rows = [(7, a), (7, b), (8, a + " z"), (9, b + " z"), (9, b + " z"), (3, None), (3, ""), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as n", "text as _hash", "doc_id as group_id", "doc_id as kept")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in got.collect()) == collections.Counter([(7, a), (7, b), (3, None), (3, ""), (None, a), (None, a)])


def test_clashing_columns(spark, folder):
    """Further columns, under names that the stages use inside, go through all of them."""
    names = ["n", "score", "kept", "_text", "component_id", "group_id", "text_hash", "predicted", "base_failed", "host_rate", "_doc_id"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", *[f"doc_id as `{x}`" for x in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and all(r["n"] == r["doc_id"] == r["text_hash"] for r in out.collect())
        docs = out
    assert corpus_pipeline.packing(spark, docs, folder).count() > 0


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
