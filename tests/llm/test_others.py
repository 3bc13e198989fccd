"""Vector search, URL verdicts, archives."""

import hashlib
import io
import os
import random
import struct
import zipfile

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from terralot.llm import queries
from terralot.llm.topk import Pivots, Searcher, top_k
from terralot.llm.url_graph import host_links, judge_urls, propagate
from terralot.llm.zip_warc import DATA, ZipArchive, read_archives, read_records, write_archives

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("chunk", [50, 4_000_000])
def test_top_k(spark, chunk):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(300, 8)).round(2))]
    rows += [(400 + i, rows[3][1]) for i in range(40)] + [(450, rows[3][1]), (450, rows[3][1])]  # many equal ones
    rows += [(500, None), (550, [1.0, None, 2.0]), (600, [float("nan")] * 8), (650, [1.0, 2.0]), (700, [float("inf")] * 8), (None, rows[0][1]), (750, []), (751, []), (800, [3.0, 1.0]), (801, [1e30] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as score", "vec_id as query_id", "vec_id as rank", "vec_id as n", "vec_id as chunk", "vec_id as items").repartition(4)
    got = {}
    for g in top_k(df, chunk_components=chunk).collect():
        got.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    good = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for i, q in good:
        if i % 50 == 0:
            scored = sorted((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(q, x)))), j) for j, x in good if j != i and len(x) == len(q))[:5]
            want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("pivots", [3, 128])
def test_bounds_hold(pivots):
    """No candidate's score is above its bound, and blocks ruled out hold none of the best."""
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 12)) * 40
    x = np.floor(centres[r.integers(0, 6, 600)] + r.normal(size=(600, 12)))
    x = x[np.lexsort(x.T)]
    table = Pivots(x[:200], float((x**2).sum(axis=1).max()), pivots)
    d = table.distances(x)
    s = Searcher(np.arange(0, 600, 50), x[::50], table, 5, np.full(12, -(2**63), np.int64))
    at, rest = table.places(d)
    assert (s.at @ at.T + s.rest[:, None] * rest + s.slack[:, None] >= x[::50] @ x.T).all()
    for i in range(0, 600, 40):
        s.add(np.arange(i, i + 40), x[i : i + 40], d[i : i + 40])
    scores = x[::50] @ x.T
    for i, (got, ids) in enumerate(s.best):
        assert list(zip(got, ids)) == [(v, j) for v, j in sorted(((scores[i, j], j) for j in range(600) if j != 50 * i), key=lambda p: (-p[0], p[1]))[:5]]
    assert s.passed > 0 and s.evaluated < 0.5 * 12 * 600


def test_verdicts(spark):
    rows = [
        (1, "http://a.net/x", None), (2, "https://WWW.Example.net/en/1?q#f", ""), (3, "http://example.com/de/", "x"), (4, "http://notexample.com/de/", "x"), (5, "http://b.org/fr/1", None), (6, "http://b.org/FR/1", None),
        (7, None, None), (8, "no scheme.net/", None), (9, "http://a.net", None), (10, "http://a.net?x=/", None), (11, "x://y://z.net/", None), (None, "http://a.net/x", None), (1, "http://a.net/x", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as host", "url as rule", "url as trust")
    got = sorted(((g["page_id"] or 0, g["host"], g["path"], g["rule"], g["verdict"]) for g in judge_urls(df).collect()), key=repr)
    want = [
        (1, "a.net", "/x", "net/", "block"), (1, "a.net", "/x", "net/", "block"), (2, "www.example.net", "/en/1", "example.net/en/", "allow"), (3, "example.com", "/de/", "example.com/de/", "block"), (4, "notexample.com", "/de/", None, "allow"),
        (5, "b.org", "/fr/1", "org/fr/", "allow"), (6, "b.org", "/FR/1", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "a.net", "", None, "block"), (10, "a.net", "", None, "block"), (11, "y:", "//z.net/", None, "allow"), (0, "a.net", "/x", "net/", "block"),
    ]
    assert got == sorted(want, key=repr)
    assert judge_urls(df.limit(0)).count() == 0


@pytest.mark.parametrize("loops", [False, True])
def test_propagation(spark, loops):
    """Against the fixed point of the walk on dense matrices."""
    r = random.Random(6)
    hosts = [f"h{i}.com" for i in range(12)]
    edges = {(r.choice(hosts[:9]), r.choice(hosts[:9])): r.randrange(1, 5) for _ in range(25)}
    edges = {k: n for k, n in edges.items() if loops or k[0] != k[1]}
    where = lambda s, d: [f"{x}//{d}" for x in ("http:", "HTTPS:", "")] + ["/x", "y?z", "?q=1"] * (s == d)
    pages = [(s, " ".join(f'<a {r.choice(["href", "hReF"])}="{r.choice(where(s, d))}">' for i in range(n)) + '<a href="mailto:a@h1.com"><a href="#top">') for (s, d), n in edges.items()]
    links = host_links(spark.createDataFrame(pages, "host string, html string"), "host", "html")
    assert {(x["src"], x["dst"]): x["n"] for x in links.collect()} == edges
    seeds = [(h, float(i % 3 == 0), float(i % 4 == 1) / 2) for i, h in enumerate(hosts)]
    got = {x["host"]: (x["trust"], x["distrust"], x["trust_share"], x["distrust_share"]) for x in propagate(spark.createDataFrame(seeds, "host string, trust double, distrust double"), links, tolerance=1e-5).collect()}
    w = np.zeros((12, 12))
    for (s, d), n in edges.items():
        w[hosts.index(s), hosts.index(d)] = n

    def fixed(m, seed):
        p = np.array([m[i] / m[i].sum() if m[i].sum() else np.eye(12)[i] for i in range(12)])
        mass = np.linalg.solve(np.eye(12) - 0.85 * p.T, 0.15 * seed)
        return mass, mass @ (p * (1 - np.eye(12)))

    seeded = [np.array([s[k] for s in seeds]) for k in (1, 2)]
    for k, m in ((0, w), (1, w.T)):
        mass, came = fixed(m, seeded[k])
        _, alike = fixed(m, np.ones(12))
        share = np.maximum(seeded[k], np.where(alike > 1e-12, came / np.maximum(alike, 1e-12), 0))
        for i, h in enumerate(hosts):
            assert np.isclose(got[h][k], mass[i], 1e-3, 1e-4) and np.isclose(got[h][k + 2], share[i], 1e-3, 1e-4)


def test_hosts_belong_to_the_domain_above(spark):
    pages = spark.createDataFrame([("a.b.example.com", None), ("a.b.example.com", ""), ("example.com", None), ("com", None), ("", "x")], "host string, html string")
    assert {(x["src"], x["dst"]): x["n"] for x in host_links(pages, "host", "html").collect()} == {("a.b.example.com", "b.example.com"): 2}


def test_spread_blocks_hosts_that_link_to_blocked_ones(spark):
    links = " ".join(f'<a href="http://bad.net/{i}">' for i in range(5))
    rows = [(i, f"http://farm.com/{i}", links) for i in range(3)] + [(10, "http://bad.net/1", None), (11, "http://fine.com/1", '<a href="/x"><a href="http://farm.org/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as src", "url as dst", "url as t0", "page_id as n")
    got = {g["page_id"]: g["verdict"] for g in judge_urls(pages).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 10: "block", 11: "allow"}


def test_blocked_domain_takes_its_hosts_along(spark):
    """No rule names blog.bad.org; the domain above it is blocked, and a sound neighbour of it isn't."""
    rows = [(1, "http://bad.org/1", None), (2, "http://bad.org/2", None), (3, "http://blog.bad.org/x", "x"), (4, "http://blog.good.org/x", "x"), (5, "http://good.org/x", "x")]
    got = {g["page_id"]: g["verdict"] for g in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), rules=[("block", "bad.org/1"), ("block", "bad.org/2")]).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


@pytest.mark.parametrize("linkers", [1, 2, 10, 40])
def test_spread_does_not_thin_out_with_more_linkers(spark, linkers):
    bad, mixed = '<a href="http://bad.net/1"><a href="/home">', '<a href="http://bad.net/1">' + '<a href="http://other.com/">' * 9
    rows = [(i, f"http://farm{i}.com/", bad) for i in range(linkers)] + [(100, "http://bad.net/1", "<a href=x>"), (101, "http://mixed.com/", mixed), (102, "http://fan.com/", '<a href="http://farm0.com/">')]
    got = {g["page_id"]: g["verdict"] for g in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "block" for i in range(linkers)) and got[100] == "block" and got[101] == "allow"


def test_spread_passes_ten_hops(spark):
    links = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(14)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 1.0, 0.0)], "host string, trust double, distrust double")
    got = {x["host"]: x["trust"] for x in propagate(seeds, links, tolerance=1e-9).collect()}
    assert all(np.isclose(got[f"h{i}"], 0.15 * 0.85**i) for i in range(14)) and np.isclose(got["h14"], 0.85**14)


def test_spread_and_its_sql(spark, tmp_path):
    """The query and its SQL on pages that link across hosts, where the spread decides verdicts."""
    r = random.Random(3)
    hosts = [f"{p}h{i}.{z}" for i in range(12) for p, z in (("", "com"), ("www.", "com"), ("", "org"), ("", "net"), ("m.", "example.com"))]
    rows = [(i, f"http://{r.choice(hosts)}/{r.choice(['de', 'en', 'fr'])}/{i}", " ".join(f"<a href='{r.choice(['/in', '//' + r.choice(hosts) + '/x', 'HTTP://' + r.choice(hosts).upper()])}'>" for _ in range(r.randrange(5)))) for i in range(300)]
    rows += [(1000 + i, f"http://only{i}.com/", f"<A HREF=http://h{i}.net/>") for i in range(5)] + [(None, None, None), (2000, "nothing", "<a href=/x>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict"]
    got = queries.QUERIES["op9_url_filter"](spark, str(tmp_path)).collect()
    want = db.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL['op9_url_filter']})").fetchall()
    assert sorted((tuple(g[c] for c in names) for g in got), key=repr) == sorted(want, key=repr)
    assert sum(g["rule"] is None and g["verdict"] == "block" for g in got) >= 5


@pytest.mark.parametrize("zip64", [False, True])
def test_archives(spark, tmp_path, zip64):
    big = "x" * 150
    rows = [(5, "http://a/", big), (3, "http://b/ c\r\n", big), (9, None, big), (None, "http://n/", big), (4, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"), (3, "http://b/ c\r\n", big), (10, "é", "é日本語 " * 40), (11, "long", "y\r\n\r\n" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html as payload", "url as digest").repartition(2)
    manifest = write_archives(df, zip64=zip64, archive_mb=1, folder=f"file://{tmp_path}")
    got = read_archives(manifest, with_payload=True).collect()
    assert len(got) == len(rows)
    for g in got:
        texts = [h or "" for i, _, h in rows if i == g["page_id"]]
        data = texts[0].encode()
        revisit = data == big.encode() and g["page_id"] != 3
        assert (g["payload_bytes"], g["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (g["record_type"], g["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert g["payload"] is None if revisit else bytes(g["payload"]) == data
    for uri in [r["uri"] for r in manifest.collect()]:
        with zipfile.ZipFile(uri.removeprefix("file://")) as z:  # another reader finds the same members
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        assert len(list(read_records(uri))) > 0
    assert read_archives(write_archives(df.limit(0))).count() == 0


def test_zip64_directory():
    """A directory whose counts and places are in the ZIP64 records only."""
    name, data = DATA.encode(), b"payload"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 3) + b"end"
    z = ZipArchive(io.BytesIO(local + central + end64 + locator + end))
    assert z.read(*z.stored(DATA)) == data
    with pytest.raises(ValueError):
        ZipArchive(io.BytesIO(b"nothing"))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr(DATA, "x" * 100)
    with pytest.raises(ValueError, match="not stored"):
        ZipArchive(packed).stored(DATA)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    cur = db.execute(queries.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted((tuple(r[names.index(c)] for c in columns) for r in cur.fetchall()), key=repr)


def test_registered():
    got = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in got if q.startswith("op")} and "pipeline" in got
