"""Quality classifier by Bradley-Terry pairwise ranking.

Training: documents labelled good are preferred to documents labelled bad.
With w.x the strength of a document with features x, the probability that a
beats b is 1 / (1 + exp(-w.(x_a - x_b))); w maximises the likelihood of the
preference pairs (logistic loss on feature differences, L2 penalty, Newton
steps).  The cutoff is a quantile of the strengths of the labelled sample, the
one that best separates its classes, and strengths are mapped to (0, 1) so
that the cutoff falls on 0.5.

Features are shares and averages of characters, words and lines of the whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.labelled import PER_CLASS, held_out, training_sample
from kestrel.llm.textkit import SPACE_WORD, Chunk, RunHasher, map_chunks, mix, run_starts, span_hashes

# Byte classes (fixed values).
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\v\f", b"\n", b".", b",;:",
            b"!", b"?", b"#*$%&", b"|<>[]{}\\/=_~^@+", b"'\"()-`"]
_KIND = np.full(256, len(_CLASSES), np.uint8)                 # other ASCII
_KIND[0x80:0xC0] = len(_CLASSES) + 1                          # inside a character
_KIND[0xC0:] = len(_CLASSES) + 2                              # first byte of a non-ASCII character
for _i, _c in enumerate(_CLASSES):
    _KIND[list(_c)] = _i
_N_KINDS = len(_CLASSES) + 3
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[10] = False


def _per_row(rows: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n).astype(np.float64)


def _distinct(rows: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Number of different hashes in each row."""
    if not len(h):
        return np.zeros(n)
    key = mix(h + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    return _per_row(rows[first], n)


def features(chunk: Chunk) -> np.ndarray:
    """Feature matrix (rows x features) of a chunk; empty texts give zeros."""
    n, data, off = chunk.n, chunk.data, chunk.offsets
    size = np.diff(off)
    at = np.repeat(np.arange(n) * _N_KINDS, size)
    kinds = np.bincount(at + _KIND[data], minlength=n * _N_KINDS).reshape(n, _N_KINDS).astype(np.float64)
    inside = kinds[:, len(_CLASSES) + 1]
    chars = np.maximum(size - inside, 1)
    w = chunk.words(SPACE_WORD)
    row, count = w.rows(), w.counts.astype(np.float64)
    words = np.maximum(count, 1)
    h = w.hashes()
    length = (w.ends - w.starts).astype(np.float64)
    same_row = row[1:] == row[:-1]
    again = np.flatnonzero(same_row & (h[1:] == h[:-1]))
    run, two, four = RunHasher(h), run_starts(w, 2), run_starts(w, 4)
    pairs, quads = np.maximum(count - 1, 1), np.maximum(count - 3, 1)
    raw = w.data
    first, last = raw[w.starts], raw[w.ends - 1]
    alpha_first = _ALPHA[chunk.data[w.starts]] if len(w) else np.zeros(0, bool)
    upper_first = (chunk.data[w.starts] >= 65) & (chunk.data[w.starts] < 91) if len(w) else np.zeros(0, bool)
    upper_total = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    caps = upper_total[w.ends] - upper_total[w.starts] >= np.maximum((length - 1) * 0.6, 1)
    stop = np.isin(last, list(b".!?"))
    mark = np.isin(last, list(b".,;:!?"))
    short = length <= 3
    lines = chunk.words(_NOT_BREAK)                            # runs without a line break
    line_row, line_count = lines.rows(), np.maximum(lines.counts, 1)
    line_hash = span_hashes(lines.data, lines.starts, lines.ends)
    mean_len = _per_row(row, n, length) / words
    var_len = np.maximum(_per_row(row, n, length ** 2) / words - mean_len ** 2, 0)
    shares = [kinds[:, i] / chars for i in range(len(_CLASSES) + 1)] + [kinds[:, -1] / chars]
    shares += [
        _per_row(row[again + 1], n) / pairs,
        1 - _distinct(row, h, n) / words,
        1 - _distinct(row[two], run.runs(two, two + 2), n) / pairs,
        1 - _distinct(row[four], run.runs(four, four + 4), n) / quads,
        _per_row(row[~alpha_first], n) / words,
        _per_row(row[upper_first], n) / words,
        _per_row(row[caps], n) / words,
        _per_row(row[stop], n) / words,
        _per_row(row[mark], n) / words,
        _per_row(row[short], n) / words,
        _per_row(row[length > 20], n) / words,
        1 - _distinct(line_row, line_hash, n) / line_count,
        np.isin(data[np.maximum(off[1:] - 1, 0)], list(b".!?")) & (size > 0) if len(data) else np.zeros(n),
    ]
    shares = np.clip(np.column_stack(shares).astype(np.float64), 0, 1)
    scales = np.column_stack([np.log1p(count), np.log1p(mean_len), np.log1p(np.sqrt(var_len)), np.log1p(words / line_count),
                              1 / (1 + count / 50)])
    out = np.hstack([shares, np.sqrt(shares), scales])
    out[count == 0] = 0
    return out


@dataclass
class Ranking:
    """Strengths w.(x - mean) / spread, mapped by slope and cutoff to (0, 1)."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cutoff: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((x - self.mean) / self.spread, -6, 6) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (s - self.cutoff), -500, 500)))


def fit_pairs(x: np.ndarray, good: np.ndarray, matches: int = 6, l2: float = 1e-3, steps: int = 25) -> Ranking | None:
    """Bradley-Terry fit on ``matches`` rounds in which every document meets one of
    the other class.  None if a class is missing."""
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return None
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / spread, -6, 6)
    m = max(len(a), len(b))
    rng = np.random.default_rng(7)
    wins = np.concatenate([rng.permutation(a)[np.arange(m) % len(a)] for _ in range(matches)])
    losses = np.concatenate([rng.permutation(b)[np.arange(m) % len(b)] for _ in range(matches)])
    d = z[wins] - z[losses]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))        # probability of the upset
        grad = d.T @ p / len(d) - l2 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    cutoff = quantile_cutoff(s, good)
    return Ranking(mean, spread, w, cutoff, _slope(s - cutoff, good))


def quantile_cutoff(s: np.ndarray, good: np.ndarray) -> float:
    """The quantile of the strengths with the best balanced accuracy; of equally
    good ones the middle one."""
    order = np.argsort(s, kind="stable")
    s, good = s[order], good[order]
    below_bad = np.concatenate([[0], np.cumsum(~good)]) / max((~good).sum(), 1)
    below_good = np.concatenate([[0], np.cumsum(good)]) / max(good.sum(), 1)
    gain = below_bad - below_good
    edge = np.concatenate([[True], s[1:] != s[:-1], [True]])  # ties stay on one side
    gain[~edge] = -1
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    at = int(best[len(best) // 2])
    low, high = s[max(at - 1, 0)], s[min(at, len(s) - 1)]
    return float((low + high) / 2)


def _slope(s: np.ndarray, good: np.ndarray, steps: int = 30) -> float:
    """Scale of the logistic map, by Newton steps on its class-balanced likelihood."""
    a, y = 1.0 / max(s.std(), 1e-9), good.astype(float)
    weight = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * s, -500, 500)))
        grad = (weight * (y - p) * s).sum() - 1e-4 * a
        a = min(max(a + grad / ((weight * p * (1 - p) * s * s).sum() + 1e-4), 0.2), 50.0)
    return float(a)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = PER_CLASS) -> Ranking | None:
    """Fits the ranking on the bounded labelled sample: features are computed in
    the tasks, only the sample's feature rows reach the driver."""
    sample = training_sample(docs, labels, label, id_col, text, per_class)

    def one(chunk: Chunk):
        x = features(chunk)
        return pa.RecordBatch.from_arrays([chunk.column("_label"), pa.FixedSizeListArray.from_arrays(
            pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["_label", "x"])

    schema = T.StructType([T.StructField("_label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    got = map_chunks(sample.select(F.col("_label").cast("int"), "_text"), schema, one, "_text").toArrow()
    if not got.num_rows:
        return None
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(got.num_rows, -1)
    return fit_pairs(x, np.array(got.column("_label")) == 1)


def _scores(chunk: Chunk, model: Ranking | None) -> np.ndarray:
    return np.full(chunk.n, 0.5) if model is None else model.score(features(chunk))


def scores(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): every row is scored from its whole text
    alone.  Null and empty texts score as a text without words; repeated rows score
    alike; without labels of both classes (model None) every score is 0.5."""
    src = docs.select(F.col(id_col), held_out(id_col).alias("_held"), F.col(text).alias("_text"))

    def one(chunk: Chunk):
        s = _scores(chunk, model)
        return pa.RecordBatch.from_arrays([chunk.column(id_col), chunk.column("_held"), pa.array(s),
                                           pa.array((s >= 0.5).astype(np.int32))], names=schema.names)

    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_chunks(src, schema, one, "_text")


def keep_good(docs: DataFrame, model: Ranking | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns, whatever their names) that score at least ``threshold``.  Null
    and empty texts score as a text without words; repeated rows are judged alike; an empty
    table gives an empty one; without a model all rows score 0.5."""
    return map_chunks(docs, docs.schema, lambda c: c.rows.filter(pa.array(_scores(c, model) >= threshold)), text)
