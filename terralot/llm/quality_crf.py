"""Quality of documents from a linear-chain conditional random field over their lines.

Each line is good or bad. Its features are counts of its own and of the lines before and after it;
transitions tie neighbouring labels. Forward-backward gives each line's marginal of being good, and
the mean of the marginals, weighted by the lines' lengths, is the document's score.

Fitting: at most `fit_rows` labelled documents (those of the least hash of their id), of each at most
`fit_lines` neighbouring lines (which ones goes by a hash of the id). The labels are the documents'; which of its lines
make a document bad is found in rounds: first every line has its document's label; then a bad document's
worst lines, up to `share` of its length, keep it and its others take the label that their features
give them. So chains may change state, and the transitions are learnt from where they do.
Scoring covers every line of every document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import in_training, sliced

FIT_ROWS, FIT_LINES, SHARE, RELABELLED, KEEP_FROM = 6000, 100, 0.7, 2, 0.7
UPPER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
MARKS, SPACES, OTHER = b"#*$%&^~@=_+\\", b" \t\r\x0b\x0c", b".,;:!?"
N_BASE = 20


def base_features(line: str, seen: bool) -> list[float]:
    """What one line shows by itself; `seen`: an earlier line of the text is equal."""
    raw = line.encode("utf-8", "replace")
    n = len(raw) or 1
    words = line.split()
    k = len(words) or 1
    distinct = len(set(words))
    less = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    same = sum(map(eq, words, words[1:]))
    return [
        1.0, math.log1p(len(raw)), math.log1p(len(words)), distinct / k, same / k, less(UPPER), less(DIGITS), less(MARKS), less(b"|"), less(b"!"), less(OTHER), less(SPACES),
        (len(raw) - len(line)) / n, min(len(raw) / k, 40.0), less(b"<>{}[]()"), less(b"/"), float(seen), float(bool(raw) and raw.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"')),
        min(4.0, max(map(len, words), default=0) / 20), float(not words),
    ]


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x 3 N_BASE + 2, lengths): own features, those of both neighbours, and whether there are any."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    rows = []
    for line in lines:
        rows.append(base_features(line, bool(line.strip()) and line in seen))
        seen.add(line)
    base = np.array(rows, np.float32)
    out = np.zeros((len(lines), 3 * N_BASE + 2), np.float32)
    out[:, :N_BASE] = base
    out[1:, N_BASE : 2 * N_BASE], out[:-1, 2 * N_BASE : 3 * N_BASE] = base[:-1], base[1:]
    out[0, -2] = out[-1, -1] = 1
    return out, np.array([len(x) for x in lines], np.float64)


class Chains:
    """Forward-backward over many chains at once; chains are taken longest first, so those that still go on come first."""

    def __init__(self, lengths: list[int]):
        n = np.array(lengths, np.int64)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        order = np.argsort(-n, kind="stable")
        self.n, self.first = n[order], first[order]
        # of the still-running chains at each step
        self.running = [int(x) for x in np.searchsorted(-self.n, -np.arange(1, (self.n.max(initial=0)) + 1), side="right")]

    def marginals(self, score: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of each line, expected transitions summed over all chains, and the sum of log Z.
        score: log weight of good against bad; trans[a, b]: log weight of b after a."""
        emit = np.stack([np.zeros_like(score), score], axis=1)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        for t, k in enumerate(self.running):
            at = self.first[:k] + t
            if t:
                before = alpha[at - 1]
                alpha[at] = np.stack([np.logaddexp(before[:, 0] + trans[0, b], before[:, 1] + trans[1, b]) for b in (0, 1)], axis=1)
            alpha[at] += emit[at]
        for t in range(len(self.running) - 2, -1, -1):
            at = self.first[: self.running[t + 1]] + t
            after = beta[at + 1] + emit[at + 1]
            beta[at] = np.stack([np.logaddexp(after[:, 0] + trans[a, 0], after[:, 1] + trans[a, 1]) for a in (0, 1)], axis=1)
        both = alpha + beta
        z = np.logaddexp(both[:, 0], both[:, 1])
        good = np.exp(both[:, 1] - z)
        moves = np.zeros((2, 2))
        follow = np.concatenate([self.first[:k] + t for t, k in enumerate(self.running) if t] or [np.zeros(0, np.int64)])
        for a in (0, 1):
            for b in (0, 1):
                moves[a, b] = np.exp(alpha[follow - 1, a] + trans[a, b] + emit[follow, b] + beta[follow, b] - z[follow]).sum()
        return good, moves, float(z[self.first].sum())


def relabelled(labels: np.ndarray, lengths: list[int], good: np.ndarray, weight: np.ndarray, share: float) -> np.ndarray:
    """A label of each line: good in good documents; in bad ones bad for the worst lines, up to `share` of the length, and else the likelier one."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((good, doc))
    total = np.bincount(doc, weight, len(lengths))
    before = np.cumsum(weight[order]) - weight[order]
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
    before -= np.repeat(before[first], lengths)
    worst = np.zeros(len(doc), bool)
    worst[order] = before < share * total[doc[order]]
    return ((labels[doc] == 1) | ~worst & (good >= 0.5)).astype(np.int64)


def fit_crf(x: np.ndarray, lengths: list[int], labels: np.ndarray, weight: np.ndarray | None = None, rounds: int = 200, again: int = RELABELLED, share: float = SHARE, l2: float = 1e-3) -> dict:
    """Weights by maximum likelihood with Adam, from line features and the labels of documents. weight: the lines' lengths."""
    f = x.shape[1]
    model = {"mean": np.zeros(f), "scale": np.ones(f), "w": np.zeros(f), "trans": np.zeros((2, 2))}
    if not len(labels):
        return model
    mean, std = x.mean(axis=0), x.std(axis=0)
    mean[0], std[std < 1e-6] = 0, 1
    std[0] = 1
    model |= {"mean": mean.astype(np.float64), "scale": std.astype(np.float64)}
    x = (x - model["mean"]) / model["scale"]
    chains, n_docs = Chains(lengths), len(labels)
    weight = np.ones(len(x)) if weight is None else weight + 1.0
    y = np.repeat(labels, lengths)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(lengths) - 1] = False
    follow = np.flatnonzero(inner)
    w, trans = np.zeros(f), np.zeros((2, 2))
    for turn in range(again + 1):
        told = np.bincount(2 * y[follow] + y[follow + 1], minlength=4).reshape(2, 2)
        m, v = np.zeros(f + 4), np.zeros(f + 4)
        for i in range(1, (rounds if not turn else rounds // 4) + 1):
            good, moves, _ = chains.marginals(x @ w, trans)
            grad = np.concatenate([x.T @ (y - good) / n_docs - l2 * w, ((told - moves) / n_docs - l2 * trans).ravel()])
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = (0.1 if not turn else 0.03) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
            w, trans = w + step[:f], trans + step[f:].reshape(2, 2)
        if turn < again:
            # by the lines' own evidence: a document's label already binds its chain
            y = relabelled(labels, lengths, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), weight, share)
    return model | {"w": w, "trans": trans}


def scores_of(texts: list[str | None], model: dict) -> tuple[list[float], list[int]]:
    made = [line_features(t) for t in texts]
    lengths = [len(n) for _, n in made]
    x = (np.concatenate([a for a, _ in made]) - model["mean"]) / model["scale"]
    good, _, _ = Chains(lengths).marginals(x @ model["w"], model["trans"])
    out, at = [], 0
    for _, n in made:
        p = good[at : at + len(n)]
        at += len(n)
        weight = n if n.sum() > 0 else np.ones(len(n))
        out.append(float(min(1.0, max(0.0, (p * weight).sum() / weight.sum()))))
    return out, lengths


def fit_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS, fit_lines: int = FIT_LINES) -> dict:
    """The model, from a bounded sample of labelled rows that the fit may see. Null labels and labels
    other than 0 and 1 are no labels; of an id with both labels none counts."""
    known = labels.filter(in_training(doc_id)).filter(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.min(label).alias("y"), F.max(label).alias("z"))
    known = known.filter("y = z").select(F.col(doc_id).cast("long").alias("doc_id"), "y").orderBy(F.xxhash64(doc_id), "doc_id").limit(fit_rows)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")  # at most fit_rows rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, y, t in zip(b["doc_id"], b["y"], b["text"]):
                x, n = line_features(t)
                at = zlib.crc32(str(i).encode()) % (len(x) - fit_lines + 1) if len(x) > fit_lines else 0
                x, n = x[at : at + fit_lines], n[at : at + fit_lines]
                out.append((i, y, len(x), x.tobytes(), n.tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "y", "n", "x", "lengths"])

    got = rows.select("doc_id", "y", "text").mapInPandas(run, "doc_id long, y int, n int, x binary, lengths binary").toPandas().sort_values(["doc_id", "n", "x"])
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, 3 * N_BASE + 2)
    weight = np.frombuffer(b"".join(got["lengths"]), np.float64)
    return fit_crf(x, [int(n) for n in got["n"]], got["y"].to_numpy(), weight)


def score_quality(docs: DataFrame, model: dict, *, doc_id: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM, carry: list[str] | None = None) -> DataFrame:
    """doc_id, score (0 to 1, higher: good likelier), predicted, n_lines of every row.

    Null text counts as empty, an empty text as one line without words. Null and repeated ids
    and repeated rows are scored row by row; rows of equal text have equal scores. All lines of a long text
    count. No rows give none. Columns named in `carry` are passed on with `_` before their names; others are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.col(c).alias("_" + c) for c in carry or []])
    names = ["doc_id", *rows.columns[2:], "score", "predicted", "n_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            score, lines = scores_of(b.column(1).to_pylist(), shared.value)
            made = [pa.array(score, pa.float64()), pa.array([int(s >= keep_from) for s in score], pa.int32()), pa.array(lines, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *made], names)

    schema = StructType([rows.schema["doc_id"], *rows.schema.fields[2:], StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("n_lines", LongType())])
    return rows.mapInArrow(run, schema)
