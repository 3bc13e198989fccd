"""Toxicity of documents whose words may be disguised.

Method: a noisy channel. Clean words come from a character language model (trigram counts over all
documents); the channel writes letters as look-alike digits and signs, repeats letters, and puts
separators between them. For a disguised token a lattice holds what each character may stand for;
Viterbi finds the likeliest reading under model and channel. The restored text is then scored.

Scoring: words and word beginnings have log odds of toxic against clean documents, lowered by two and
a half standard errors, from a bounded labelled sample (`fit_rows` documents of the least hash of their
id; all its features count). A document's score is a logistic function of the two largest weights among
its distinct words, of the sum of all their squares, of how many distinct tokens it has, and of that sum
against their number. The curve is fitted to the whole sample, each quarter of it read with the weights
of the other three.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import count_blocks, in_training, sliced, staged, sum_blocks

FIT_ROWS, FOLDS, TOXIC_FROM = 12_000, 4, 0.3
#: A weight is the log odds less so many standard errors, if above the least one.
ERRORS, LEAST_WEIGHT = 2.5, 0.5
CLASSES, LETTERS = 64, "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
OTHER = len(LETTERS) + 1
#: What digits and signs stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
SIGNS, GAPS, EDGES = set("*#%&@$!|+€£(¡~^=_-.'"), set(" .-_*/"), ".,;:?\"'()[]{}<>«»…"
LOOK_COST, DROP_OUTER, DROP_INNER, KEEP_SIGN, ONE_OF_TWO, ONE_OF_MANY, APART = 1.0, 1.0, 12.0, 9.0, 2.0, 0.5, 3.0
LETTER, SIGN = re.compile(r"[^\W\d_]"), re.compile(r"[0-9@$!|+€£(¡*#%&]")
TWICE_OR_APART = re.compile(r"([^\W\d_])\1|[^\W_][.\-_*/][^\W_]")
_MARKS = "".join(map(re.escape, (c for c in LOOKS if not c.isalnum())))
#: Units set apart: letters, digits and look-alike signs, each alone, with any run of white space or
#: punctuation between them. A bar is a unit where gaps stand around it, else a gap. Runs are
#: possessive, so a text is matched in linear time.
_UNIT, _GAP = rf"(?:[^\W_]|[{_MARKS}])(?![^\W_])", rf"(?:(?![{_MARKS}])[\W_])"
SPACED = re.compile(rf"(?<![^\W_]){_UNIT}(?:(?>{_GAP}++{_UNIT}|{_GAP}*+\|++{_GAP}*+{_UNIT})){{2,}}+")
GAP_OR_UNIT = re.compile(rf"{_GAP}++{_UNIT}|{_GAP}*+\|++{_GAP}*+{_UNIT}")
#: Tokens up to this length are cached; longer ones are decoded each time.
CACHED = 64


def odd(token: str) -> bool:
    """Whether a token has letters beside signs or digits, a letter twice, or letters set apart. Linear in its length."""
    return bool(LETTER.search(token) and SIGN.search(token) or TWICE_OR_APART.search(token))


def class_table() -> np.ndarray:
    """Letter class of each code point below 2^16: 0 for what is no letter."""
    out = np.zeros(1 << 16, np.int64)
    for i in range(1 << 16):
        if chr(i).isalpha():
            out[i] = OTHER
    for i, c in enumerate(LETTERS):
        out[ord(c)] = i + 1
    return out


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Letter trigrams of all texts, lower case, words apart: CLASSES^3 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        counts = np.zeros(CLASSES**3, np.int64)
        for b in sliced(batches):
            text = "  ".join(x for x in b.column(0).to_pylist() if x).lower()
            points = np.frombuffer(f"  {text}  ".encode("utf-32-le", "replace"), np.uint32)
            c = np.where(points < 1 << 16, table[np.minimum(points, (1 << 16) - 1)], OTHER)
            counts += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        used, packed = count_blocks(counts, 4096)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], ["block", "counts"])

    return sum_blocks(staged(texts.mapInArrow(run, "block int, counts binary"), "trigrams"), CLASSES**3, 4096)


def log_model(counts: np.ndarray) -> list[float]:
    """log P(c | a, b) at (a CLASSES + b) CLASSES + c: trigrams backed by bigrams and these by letters."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).reshape(-1).tolist()


class Restorer:
    """Readings of disguised tokens and spans under a language model; the latest are kept."""

    def __init__(self, model: list[float]):
        self.model = model
        self.number = {c: i + 1 for i, c in enumerate(LETTERS)}
        self.kept: dict[str, list[str]] = {}

    def options(self, c: str, n: int, inner: bool, apart: bool = False) -> list[tuple[float, str]]:
        """(cost, what is read) for a run of n equal characters; apart: of a span as `canonical` writes it."""
        if apart and c in " \n":
            return [(0.0, ""), (APART if c == " " else 0.0, " ")]
        if c.isalpha():
            if n == 1:
                return [(0.0, c)]
            return [(ONE_OF_TWO, c), (0.0, c + c)] if n == 2 else [(ONE_OF_MANY, c), (ONE_OF_MANY, c + c)]
        out = [(KEEP_SIGN + n - 1, c * n)]
        for x in LOOKS.get(c, ""):
            out.append((LOOK_COST, x))
            if n > 1:
                out.append((LOOK_COST, x + x))
        if apart and c == "|":
            return [*out, (LOOK_COST, "")]
        if inner and c in GAPS:
            return [*out, (0.0, ""), (APART, " ")]
        if c in SIGNS or c.isdigit():
            out.append((DROP_INNER if inner or c.isdigit() else DROP_OUTER, ""))
        return out

    def decode(self, token: str, apart: bool = False) -> str:
        """Viterbi over the lattice; a state is the last two letter classes. Linear in the length: readings are kept by back-pointers."""
        runs: list[list] = []
        for c in token:
            if runs and runs[-1][0] == c:
                runs[-1][1] += 1
            else:
                runs.append([c, 1])
        model, number = self.model, self.number
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        last = len(runs) - 1
        for i, (c, n) in enumerate(runs):
            options = [(cost, read, [number.get(x, OTHER if x.isalpha() else 0) for x in read]) for cost, read in self.options(c, n, 0 < i < last, apart)]
            new: dict[int, tuple[float, tuple | None]] = {}
            for state, (value, text) in states.items():
                for cost, read, classes in options:
                    now, at = value - cost, state
                    for k in classes:
                        at = at << 6 | k
                        now += model[at]
                        at &= 0xFFF
                    known = new.get(at)
                    if known is None or now > known[0]:
                        new[at] = (now, (read, text))
            states = new
        text = max(((value + model[at << 6], text) for at, (value, text) in states.items()), key=lambda x: x[0])[1]
        reads = []
        while text is not None:
            read, text = text
            reads.append(read)
        return "".join(reversed(reads))

    def words(self, token: str) -> list[str]:
        """The words a lower-case token stands for: as it is without outer marks, and as restored if it looks disguised."""
        known = self.kept.get(token)
        if known is None:
            plain = token.strip(EDGES)
            known = [plain] if plain else []
            if odd(token):
                known += [x for x in (y.strip(EDGES + "!*") for y in self.decode(token.strip(EDGES)).split()) if x and x != plain]
            if len(self.kept) > 400_000:
                self.kept.clear()
            if len(token) <= CACHED:
                self.kept[token] = known
        return known

    def canonical(self, span: str) -> str | None:
        """A span's units with a blank for each gap, and a line break for a gap longer than the least one. None with fewer than two letters."""
        if len(LETTER.findall(span)) < 2:
            return None
        steps = [m[0] for m in GAP_OR_UNIT.finditer(span, 1)]
        least = min(map(len, steps))
        return span[0] + "".join((" " if len(x) == least else "\n") + x[-1] for x in steps)

    def read_span(self, span: str) -> str:
        text = self.canonical(span)
        return span if text is None else self.decode(text, True)

    def spans(self, text: str) -> list[str]:
        """Words read from letters set apart by separators, in a lower-case text."""
        return [x for m in SPACED.finditer(text) for x in (y.strip(EDGES) for y in self.read_span(m[0]).split()) if len(x) > 2]

    def restored(self, text: str) -> str:
        """The whole text in lower case with disguised tokens and spans restored."""
        text = SPACED.sub(lambda m: self.read_span(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self.decode(m[0]) if odd(m[0].strip(EDGES)) else m[0], text)


def features(word: str) -> list[str]:
    """A word and its beginnings of 3 to 6 letters."""
    return ["=" + word, *(f"^{word[:k]}" for k in (3, 4, 5, 6) if len(word) >= k)]


class Scorer:
    """The numbers that a document's score is made of."""

    def __init__(self, restorer: Restorer, weights: dict[str, float]):
        self.restorer, self.weights = restorer, weights
        self.kept: dict[str, tuple] = {}

    def weight(self, word: str) -> float:
        get = self.weights.get
        return max(get(f, 0.0) for f in features(word))

    def found(self, token: str) -> tuple:
        """The words a token stands for that have a weight, with it."""
        value = self.kept.get(token)
        if value is None:
            value = tuple((w, v) for w in self.restorer.words(token) if (v := self.weight(w)) > 0)
            if len(self.kept) > 400_000:
                self.kept.clear()
            if len(token) <= CACHED:
                self.kept[token] = value
        return value

    def numbers(self, text: str | None) -> tuple[float, ...]:
        low = (text or "").lower()
        tokens = set(low.split())
        known: dict[str, float] = {}
        for pairs in map(self.found, tokens):
            if pairs:
                known.update(pairs)
        known.update((w, v) for w in set(self.restorer.spans(low)) if (v := self.weight(w)) > 0)
        top = sorted(known.values(), reverse=True)
        squares, n = math.fsum(v * v for v in top), len(tokens)
        return (top[0] if top else 0.0), (top[1] if len(top) > 1 else 0.0), math.log1p(squares), math.log1p(n), math.log1p(squares / math.sqrt(n + 1))


NUMBERS = "a double, b double, c double, d double, e double"


def log_odds(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Of a feature in so many of all toxic and of all clean documents, lowered by its errors."""
    return math.log((toxic + 0.5) / (clean + 0.5)) - math.log((all_toxic + 1) / (all_clean + 1)) - ERRORS * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's steps, lightly regularised; the last weight is the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> dict:
    """The language model from all documents, weights and curve from a bounded sample of labelled
    rows that the fit may see. Null labels and labels other than 0 and 1 are none; of an id with both none counts."""
    context = docs.sparkSession.sparkContext
    model = log_model(trigram_counts(docs.select(text)))
    shared = context.broadcast(model)
    known = labels.filter(in_training(doc_id)).filter(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.min(label).alias("y"), F.max(label).alias("z"))
    known = known.filter("y = z").select(F.col(doc_id).cast("long").alias("doc_id"), "y").orderBy(F.xxhash64(doc_id), "doc_id").limit(fit_rows)
    sample = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")  # at most fit_rows rows
    sample = staged(sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        seen: dict[tuple[int, int], Counter] = {}
        for b in sliced(batches):
            for y, part, t in zip(*(c.to_pylist() for c in b.columns)):
                low = (t or "").lower()
                words = {w for token in set(low.split()) for w in restorer.words(token)} | set(restorer.spans(low))
                seen.setdefault((part, y), Counter()).update({f for w in words for f in features(w)} | {""})  # the empty feature counts documents
        for (part, y), counts in seen.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys()), pa.array([part] * n, pa.int32()), pa.array([y] * n, pa.int32()), pa.array(counts.values(), pa.int64())], ["f", "part", "y", "n"])

    counts = sample.select("y", "part", "text").mapInArrow(count, "f string, part int, y int, n long")
    of = lambda part, y: F.coalesce(F.sum(F.when((F.col("part") == part) & (F.col("y") == y), F.col("n"))), F.lit(0)).alias(f"n{part}_{y}")
    each = [of(part, y) for part in range(FOLDS) for y in (0, 1)]
    # a feature of fewer than two toxic documents has no weight
    odds = counts.groupBy("f").agg(*each).filter("f = '' OR " + " + ".join(f"n{part}_1" for part in range(FOLDS)) + " >= 2")
    rows = {r["f"]: r for r in odds.collect()}  # features of the bounded sample
    total = rows.pop("", None)

    def weights(without: int | None) -> dict[str, float]:
        parts = [p for p in range(FOLDS) if p != without]
        n = lambda r, y: sum(r[f"n{p}_{y}"] for p in parts)
        found = ((f, log_odds(n(r, 1), n(r, 0), n(total, 1), n(total, 0))) for f, r in rows.items())
        return {f: w for f, w in found if w > LEAST_WEIGHT}

    held = context.broadcast([weights(p) for p in range(FOLDS)])

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        scorers = [Scorer(restorer, w) for w in held.value]
        for b in batches:
            yield pd.DataFrame([(y, *scorers[p].numbers(t)) for y, p, t in zip(b["y"], b["part"], b["text"])], columns=["y", "a", "b", "c", "d", "e"])

    got = sample.select("y", "part", "text").mapInPandas(numbers, f"y int, {NUMBERS}").toPandas().sort_values(["y", "a", "b", "c", "d", "e"])
    curve = fit_curve(got[["a", "b", "c", "d", "e"]].to_numpy(), got["y"].to_numpy(dtype=np.float64)) if len(got) else np.zeros(6)
    return {"model": model, "weights": weights(None), "curve": curve}


def score_toxicity(docs: DataFrame, fitted: dict, *, doc_id: str = "doc_id", text: str = "text", toxic_from: float = TOXIC_FROM, with_text: bool = False) -> DataFrame:
    """doc_id, score (0 to 1, higher: toxic likelier) and predicted of every row (with_text: restored, the text as read).

    Null text counts as empty. Null and repeated ids and repeated rows are scored row by row. Tokens and spans
    of any length are decoded whole, in time linear in it, and all of a long text counts. Of readings of equal
    value the first counts. No rows give none; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    names = ["doc_id", "score", "predicted"] + ["restored"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        scorer = Scorer(Restorer(f["model"]), f["weights"])
        *w, constant = (float(x) for x in f["curve"])
        for b in sliced(batches):
            texts = b.column(1).to_pylist()
            scores = []
            for t in texts:
                z = constant + sum(x * y for x, y in zip(w, scorer.numbers(t)))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            columns = [b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= toxic_from) for s in scores], pa.int32())]
            if with_text:
                columns.append(pa.array([scorer.restorer.restored(t or "") for t in texts]))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int" + ", restored string" * with_text)
