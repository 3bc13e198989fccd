"""Rules, quality, toxicity and near duplicates."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest

import terralot.llm.jaccard_join as jaccard
from terralot.llm import toxicity
from terralot.llm.quality_crf import Chains, fit_crf, fit_quality, line_features, relabelled, score_quality, scores_of
from terralot.llm.quality_rules import quality_rules
from terralot.llm.toxicity import Restorer, fit_toxicity, log_model, score_toxicity, trigram_counts

from .conftest import ROWS

WORD = r"[^\x20\x09-\x0D]+"


def counted(text):
    t = text or ""
    w = re.findall(WORD, t)
    c = collections.Counter(zip(w, w[1:], w[2:]))
    places = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(places)


def test_rules(spark, edge, none):
    r = random.Random(2)
    more = [(100 + i, " ".join(r.choice("abcdef") for _ in range(r.randrange(120))) + "\n" * (i % 3) + "a b c", f"h{i % 4}") for i in range(60)]
    rows = ROWS + more
    got = quality_rules(edge.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))).collect()
    want = collections.Counter((i, *counted(t)) for i, t, _ in rows)
    assert want == collections.Counter((g["doc_id"], g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) for g in got)
    fails = collections.defaultdict(list)
    for _, t, s in rows:
        n, *_, again = counted(t)
        fails[s].append(n < 50 or 100 * again > 50 * n)
    rates = {s: np.mean(v) for s, v in fails.items() if s is not None}
    m, v = np.mean(list(rates.values())), np.var(list(rates.values()))
    k = max(m * (1 - m) / v - 1, 0)
    for g in got:
        bad = g["n_words"] < 50 or 100 * g["n_repeat_words"] > 50 * g["n_words"]
        f = fails[g["source"]]
        host = g["source"] is not None and (sum(f) + m * k) / (len(f) + k) >= 0.5
        assert g["base_failed"] == bad and g["kept"] == (not bad and not host)
    assert quality_rules(none).count() == 0 and quality_rules(edge).count() == len(ROWS)


def test_marginals_against_all_labellings():
    r = np.random.default_rng(3)
    lengths = [1, 4, 2, 5]
    score, trans = r.normal(size=sum(lengths)), r.normal(size=(2, 2))
    good, moves, logz = Chains(lengths).marginals(score, trans)
    want_moves, want_z, at = np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        s = score[at : at + n]
        weights = {y: np.exp(sum(s[i] for i in range(n) if y[i]) + sum(trans[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=n)}
        z = sum(weights.values())
        want_z += np.log(z)
        assert np.allclose(good[at : at + n], [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)])
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_moves[a, b] += w / z
        at += n
    assert np.allclose(moves, want_moves) and np.isclose(logz, want_z)


def prose(r, n):
    return " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randrange(2, 8))) for _ in range(n)).capitalize() + "."


def corpus(n=400):
    """(doc_id, text, quality, toxic): bad ones shout, repeat or carry marks; toxic ones insult, some in disguise."""
    r = random.Random(9)
    insults = ["blorgface", "vexmuck", "grotnog"]
    out = []
    for i in range(n):
        lines = [prose(r, r.randrange(20, 60)) for _ in range(r.randrange(1, 5))]
        quality, toxic = int(r.random() > 0.3), int(r.random() < 0.3)
        if toxic:
            for _ in range(2):
                k = r.randrange(len(lines))
                lines[k] = lines[k].replace(" ", f" {r.choice(insults)} ", 1)
        if not quality:
            kind = r.randrange(3)
            lines = [x.upper().replace(" ", "!! ") if kind == 0 else " ".join(w + "$$$" for w in x.split()) if kind == 1 else " ".join([x.split()[0]] * 40) for x in lines]
            toxic = 0 if kind == 2 else toxic
        out.append((i, "\n".join(lines), quality, toxic))
    return out


def test_quality_held_out(spark, edge, none, labels, no_labels):
    rows = corpus()
    docs, marks = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q, _ in rows], "doc_id long, quality int")
    model = fit_quality(docs, marks)
    got = {r["doc_id"]: r for r in score_quality(docs, model).collect()}
    held = [(i, q) for i, _, q, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 60 and np.mean([got[i]["predicted"] == q for i, q in held]) > 0.95
    assert scores_of([rows[0][1]], model)[0][0] == got[0]["score"]
    for some in (labels, no_labels):
        scored = score_quality(edge, fit_quality(edge, some), carry=["source", "score"]).collect()
        assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
    assert score_quality(none, fit_quality(none, no_labels)).count() == 0


def test_toxicity_held_out(spark, edge, none, labels, no_labels):
    rows = corpus()
    docs, marks = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, x) for i, _, _, x in rows], "doc_id long, toxic int")
    fitted = fit_toxicity(docs, marks)
    got = {r["doc_id"]: r for r in score_toxicity(docs, fitted, with_text=True).collect()}
    held = [(i, x) for i, _, _, x in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["predicted"] == x for i, x in held]) > 0.95
    disguised = ["bl0rgf4c3", "v e x m u c k", "gr0tn0g", "blooorgface", "v-e-x-m-u-c-k", "grot.nog", "VEXMUUUCK"]
    clean = prose(random.Random(1), 40)
    new = spark.createDataFrame([(i, f"{clean} {d} {d} grotnog {clean}") for i, d in enumerate(disguised)] + [(100, clean)], "doc_id long, text string")
    result = {r["doc_id"]: r for r in score_toxicity(new, fitted, with_text=True).collect()}
    assert result[100]["predicted"] == 0 and all(result[i]["predicted"] == 1 for i in range(len(disguised)))
    read = [any(w in result[i]["restored"] for w in ("blorgface", "vexmuck")) or result[i]["restored"].count("grotnog") > 1 for i in range(len(disguised))]
    assert all(read), read
    for some in (labels, no_labels):
        scored = score_toxicity(edge, fit_toxicity(edge, some), with_text=True).collect()
        assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
    assert score_toxicity(none, fit_toxicity(none, no_labels)).count() == 0


def all_readings(restorer, token):
    """The value of every reading of a token: what the channel may have written it from, under the model."""
    runs = [(c, len(list(g))) for c, g in itertools.groupby(token)]
    options = [restorer.options(c, n, 0 < i < len(runs) - 1) for i, (c, n) in enumerate(runs)]
    out = {}
    for reading in itertools.product(*options):
        state, total = 0, 0.0
        for cost, read in reading:
            total -= cost
            for ch in read:
                state = state << 6 | restorer.number.get(ch, 0 if not ch.isalpha() else 59)
                total += restorer.model[state]
                state &= 0xFFF
        text = "".join(r for _, r in reading)
        out[text] = max(out.get(text, -np.inf), total + restorer.model[state << 6])
    return out


def test_toxicity_by_brute_force(spark):
    """Weights recounted from all texts and labels, the curve's gradient, and scores by the formula."""
    disguised = {"blorgface": "bl0rgface", "vexmuck": "vexmuuck", "grotnog": "gr0tnog"}
    r = random.Random(12)
    rows = [(i, " ".join(disguised.get(w, w) if r.random() < 0.3 else w for w in t.split(" ")), x) for i, t, _, x in corpus(120)]
    rows += [(500, None, 0), (501, "", 0), (502, "blorgface blorgface\tgr0tnog", 1)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").repartition(3)
    fitted = fit_toxicity(docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int"))
    restorer = Restorer(fitted["model"])
    parts = {x["doc_id"]: x["p"] for x in docs.selectExpr("doc_id", "cast(pmod(xxhash64(doc_id, 1), 4) as int) as p").collect()}

    def words(text):
        out = set()
        for token in set((text or "").lower().split()):
            plain = token.strip(toxicity.EDGES)
            out |= {plain} - {""}
            if toxicity.odd(token):
                readings = all_readings(restorer, plain)
                out |= {y for x in max(readings, key=readings.get).split() if (y := x.strip(toxicity.EDGES + "!*"))}
        return out | set(restorer.spans((text or "").lower()))

    of = lambda w: {"=" + w} | {"^" + w[:k] for k in range(3, 7) if len(w) >= k}
    seen = [(i, x, {f for w in words(t) for f in of(w)}, words(t), len(set((t or "").lower().split()))) for i, t, x in rows]
    train = [s for s in seen if zlib.crc32(str(s[0]).encode()) % 4 != 2]

    def weights(some):
        n, counts = collections.Counter(s[1] for s in some), collections.Counter((f, s[1]) for s in some for f in s[2])
        out = {}
        for f in {f for f, _ in counts}:
            a, b = counts[f, 1] + 0.5, counts[f, 0] + 0.5
            v = np.log(a / b) - np.log((n[1] + 1) / (n[0] + 1)) - 2.5 * np.sqrt(1 / a + 1 / b)
            if v > 0.5:
                out[f] = v
        return out

    want = weights(train)
    assert want.keys() == fitted["weights"].keys() and all(np.isclose(want[f], v) for f, v in fitted["weights"].items()) and any("blorg" in f for f in want)

    def numbers(s, w):
        top = sorted((v for x in s[3] if (v := max(w.get(f, 0) for f in of(x))) > 0), reverse=True)
        q = sum(v * v for v in top)
        return [*(top + [0, 0])[:2], np.log1p(q), np.log1p(s[4]), np.log1p(q / np.sqrt(s[4] + 1))]

    folds = [weights([s for s in train if parts[s[0]] != p]) for p in range(4)]
    x = np.array([[*numbers(s, folds[parts[s[0]]]), 1] for s in train])
    p = 1 / (1 + np.exp(-x @ fitted["curve"]))
    assert np.abs(x.T @ (np.array([s[1] for s in train]) - p) - 0.1 * fitted["curve"]).max() < 1e-3
    got = {g["doc_id"]: g["score"] for g in score_toxicity(docs, fitted).collect()}
    for s in seen:
        z = np.clip(np.dot([*numbers(s, want), 1], fitted["curve"]), -30, 30)
        assert np.isclose(got[s[0]], 1 / (1 + np.exp(-z)))


def test_quality_by_brute_force(spark):
    """Scores from all labellings of a document's lines."""
    rows = corpus(150)
    model = fit_quality(spark.createDataFrame([(i, x) for i, x, _, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q, _ in rows], "doc_id long, quality int"))
    texts = [x for _, x, _, _ in rows[:12]] + [None, "", "\n\n", "a\n" * 8 + "$$$ !!! ###"]
    for text, score in zip(texts, scores_of(texts, model)[0]):
        x, lengths = line_features(text)
        s = ((x - model["mean"]) / model["scale"]) @ model["w"]
        total, good = 0.0, np.zeros(len(s))
        for y in itertools.product((0, 1), repeat=len(s)):
            weight = np.exp(np.dot(s, y) + sum(model["trans"][a, b] for a, b in zip(y, y[1:])))
            total, good = total + weight, good + weight * np.array(y)
        lengths = lengths if lengths.sum() else np.ones(len(lengths))
        assert np.isclose(score, np.dot(good / total, lengths) / lengths.sum())


def test_lines_of_bad_documents_may_be_good():
    good = np.array([0.9, 0.2, 0.9, 0.8, 0.1, 0.95])
    assert relabelled(np.array([1, 0]), [2, 4], good, np.array([5.0, 5, 5, 5, 5, 5]), 0.5).tolist() == [1, 1, 1, 0, 0, 1]
    r = np.random.default_rng(5)
    lengths, labels, rows = [], [], []
    for d in range(200):
        bad = d % 2
        kinds = [1, 1, 0, 0, 1] if bad else [1] * 5  # two bad lines, side by side, in each bad document
        rows += [[1, k + 0.3 * r.normal()] for k in kinds]
        lengths.append(5)
        labels.append(1 - bad)
    model = fit_crf(np.array(rows, np.float32), lengths, np.array(labels), share=0.4)
    p, _, _ = Chains([5]).marginals((np.array([[1, 1], [1, 1], [1, 0], [1, 0], [1, 1]]) - model["mean"]) / model["scale"] @ np.diag(np.ones(2)) @ model["w"], model["trans"])
    assert (p > 0.5).tolist() == [True, True, False, False, True]


def test_documents_of_many_lines_are_fitted_too(spark):
    text = {1: "\n".join(prose(random.Random(i), 12) for i in range(500)), 0: "\n".join("!!! $$$ ### %%%" for _ in range(500))}
    rows = [(i, text[i % 2], i % 2) for i in range(24)]
    model = fit_quality(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))
    scores, _ = scores_of([text[0], text[1]], model)
    assert scores[0] < 0.1 and scores[1] > 0.9


def test_viterbi_against_all_readings(spark):
    texts = spark.createDataFrame([("the idle moron met a trusty otter on the moor",)] * 3, "text string")
    restorer = Restorer(log_model(trigram_counts(texts)))

    for token in ("m0r0n", "mooron", "m-o-r", "tr|ust", "0tt3r", "idl3$"):
        every = all_readings(restorer, token)
        assert np.isclose(every[restorer.decode(token)], max(every.values()))


@pytest.fixture(scope="module")
def reader(spark):
    text = "you are a stupid idiot and a pathetic loser who talks trash about a moron"
    return Restorer(log_model(trigram_counts(spark.createDataFrame([(text,)] * 30, "text string"))))


@pytest.mark.parametrize("text, word", [
    ("i d ! o t", "idiot"), ("t r @ s h", "trash"), ("l o $ e r", "loser"), ("$ t u p i d", "stupid"), ("p @ t h e t i c", "pathetic"), ("m 0 r 0 n", "moron"), ("s   t   u   p   i   d", "stupid"),
    ("t\tr\ta\ts\th", "trash"), ("l\no\ns\ne\nr", "loser"), ("s,t,u,p,i,d", "stupid"), ("s|t|u|p|i|d", "stupid"), ("s | t | u | p | i | d", "stupid"), ("p . @ , t - h | e . t ! c", "pathetic"),
    ("s t u p i d   l o s e r", "stupid loser"),
])
def test_combined_disguises(reader, text, word):
    assert set(word.split()) <= set(reader.spans(f"who talks {text} about")) and word in reader.restored(f"who talks {text} about")
    assert reader.restored("who talks, about: a moron") == "who talks, about: a moron" and reader.restored("| - | - |") == "| - | - |"


def test_spans_in_linear_time(reader):
    for text in ("| " * 100_000, "a |" * 50_000 + "bb", "! , " * 50_000 + "x1"):
        reader.spans(text)


def test_long_disguises(reader):
    assert "idiot" in reader.words("idi" + "o" * 65 + "t")
    phrase = "you are a stupid idiot and a pathetic loser who talks trash"
    joined = ".".join(phrase.replace(" ", ""))
    assert len(joined) > 64 and {"pathetic", "trash"} <= set(reader.words(joined))
    apart = " ".join(phrase.replace(" ", "") * 40)
    assert reader.spans(apart).count("pathetic") == 40 and reader.restored(apart).count("pathetic") == 40
    assert reader.words("ab" * 100_000 + "c") and reader.words("a1b" * 30_000)  # in linear time


def similar(rows, n, percent):
    """By brute force, of rows (id, text): each row's set, links to other sets, group of linked sets, and component of its id."""
    made = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        made.append(frozenset({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    root = {}

    def top(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    known = list({s for (i, _), s in zip(rows, made) if s and i is not None})
    links = collections.Counter()
    for a, b in itertools.combinations(known, 2):
        both = len(a & b)
        if both and 100 * both >= percent * len(a | b):
            links.update((a, b))
            root[top(a)] = top(b)
    group = {s: top(s) for s in known}
    for (i, _), s in zip(rows, made):
        if i is not None and s:
            root[top(s)] = top(i)
    ids = collections.defaultdict(list)
    for i in {i for i, _ in rows if i is not None}:
        ids[top(i)].append(i)
    return made, links, group, {i: min(v) for v in ids.values() for i in v}


def as_expected(got, rows, n, percent):
    made, links, group, component = similar(rows, n, percent)
    assert len(got) == len(rows)
    want = collections.Counter((i, len(s), None if i is None else component[i], 0 if i is None else links[s]) for (i, _), s in zip(rows, made))
    assert collections.Counter((g["doc_id"], g["n_shingles"], g["component_id"], g["n_links"]) for g in got) == want
    by_group = collections.defaultdict(collections.Counter)
    for g in got:
        if g["group_id"] is not None:
            by_group[g["group_id"]][g["doc_id"]] += 1
    expected = collections.defaultdict(collections.Counter)
    for (i, _), s in zip(rows, made):
        if i is not None and s:
            expected[group[s]][i] += 1
    key = lambda groups: collections.Counter(frozenset(c.items()) for c in groups.values())
    assert key(by_group) == key(expected)


def clouds():
    """Clouds of near copies, exact copies, shared passages, rows of one id with other texts."""
    r = random.Random(5)
    base = [[f"w{r.randrange(4000)}" for _ in range(120)] for _ in range(3)]
    rows = []
    for i in range(200):
        w = list(base[i % 3])
        for _ in range(r.randrange(7)):
            w[r.randrange(len(w))] = f"x{r.randrange(200)}"
        rows.append((i * 3 + 1, " ".join(w[: r.randrange(1, 120)] if r.random() < 0.1 else w)))
    rows += [(9000 + i, rows[i % 7][1]) for i in range(30)] + [(9503, "One two"), (9504, "one  TWO"), (9505, "one"), (9506, "É"), (9507, "é")]
    rows += [(4, " ".join(base[1])), (9503, rows[5][1]), (9505, None), (9505, rows[8][1] + " z"), (9600, ""), (9600, rows[30][1])]
    return rows + [(None if i is None else 20_000 + i, t) for i, t, _ in ROWS]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("small", [True, False])
def test_jaccard_against_brute_force(spark, monkeypatch, n, percent, small):
    """Blocks small enough to be split, and as they are."""
    if small:
        monkeypatch.setattr(jaccard, "BLOCK_GROUPS", 20)
        monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 7)
        monkeypatch.setattr(jaccard, "UNION_LINKS", 10)
    rows = clouds()
    as_expected(jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), n=n, percent=percent).collect(), rows, n, percent)


@pytest.mark.parametrize("size", [3, 256])
def test_jaccard_groups_of_one_prefix(spark, monkeypatch, size):
    """Sets of one size and prefix that differ in their most frequent shingles only: they are expanded to their members."""
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", size)
    common = [f"c{i}" for i in range(14)]
    rows = [(1000 + i, f"f{i} " + c) for i, c in enumerate(common * 30)]  # makes them frequent
    for f in range(4):
        rare = [f"r{f // 2}x{k}" for k in range(40)]
        rows += [(10 * f + k, " ".join(rare + random.Random(k + 50 * f).sample(common, 6 + f % 2))) for k in range(9)]
    as_expected(jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n=1, percent=88).collect(), rows, 1, 88)


def test_jaccard_rows_of_one_id(spark):
    """A row's links are its text's, whatever other texts its id has."""
    a = " ".join(f"a{i}" for i in range(100))
    b = " ".join(f"b{i}" for i in range(100))
    rows = [(7, a), (7, b), (8, a + " z"), (9, b + " z"), (10, a + " y")]
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=90).collect()
    as_expected(got, rows, 3, 90)
    assert {g["component_id"] for g in got} == {7} and len({g["group_id"] for g in got}) == 2


def test_jaccard_edges(edge, none):
    assert jaccard.jaccard_join(edge).count() == len(ROWS)
    assert jaccard.jaccard_join(none).count() == 0
