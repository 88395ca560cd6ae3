"""Counterfactual-regularised toxicity classifier.

A logistic model over the presence of words and word beginnings (hashed).
Their weights are not negative (projected and soft-thresholded steps): evidence
of toxicity adds up and a long harmless rest of the text doesn't cancel it.
Counterfactuals: in every labelled sentence that mentions an identity term the
term is swapped for each other term of its group and for the neutral word; the
squared change of the sentence's score is added to the loss, weighted by
``penalty``.  The model therefore cannot lean on who is mentioned, and neutral
mentions of a group don't raise the score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.labelled import PER_CLASS, held_out, training_sample
from kestrel.llm.scratch import stored
from kestrel.llm.textkit import ALNUM_WORD, Chunk, HashIndex, map_chunks, span_hashes

# Identity terms by group; the first term of each group is the neutral one.
IDENTITY_TERMS = {
    "en": [["people", "women", "men", "girls", "boys", "gays", "lesbians", "transgender", "straight"],
           ["person", "woman", "man", "girl", "boy", "gay", "lesbian", "queer"],
           ["believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"],
           ["believer", "christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"],
           ["citizens", "immigrants", "refugees", "foreigners", "africans", "asians", "latinos", "arabs", "europeans", "americans"],
           ["citizen", "immigrant", "refugee", "foreigner", "african", "asian", "latino", "arab", "european", "american",
            "black", "white"],
           ["adult", "old", "young", "elderly", "disabled", "blind", "deaf"]],
    "fr": [["personnes", "femmes", "hommes", "filles", "garçons", "homosexuels", "lesbiennes"],
           ["croyants", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"],
           ["citoyens", "immigrés", "réfugiés", "étrangers", "africains", "asiatiques", "arabes", "noirs", "blancs"]],
    "de": [["menschen", "frauen", "männer", "mädchen", "jungen", "schwule", "lesben"],
           ["gläubige", "christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"],
           ["bürger", "einwanderer", "flüchtlinge", "ausländer", "afrikaner", "asiaten", "araber", "schwarze", "weiße"]],
    "es": [["personas", "mujeres", "hombres", "niñas", "niños", "homosexuales", "lesbianas"],
           ["creyentes", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"],
           ["ciudadanos", "inmigrantes", "refugiados", "extranjeros", "africanos", "asiáticos", "árabes", "negros", "blancos"]],
}

BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
_NOT_SENTENCE_END = np.ones(256, bool)
_NOT_SENTENCE_END[list(b".!?\n")] = False


def _term_hashes(word: str) -> np.ndarray:
    """Feature hashes of one lower-case word: itself and its beginnings."""
    raw = np.frombuffer(word.encode(), np.uint8)
    ends = [len(raw)] + [k for k in BEGINNINGS if k < len(raw)]
    h = span_hashes(raw, np.zeros(len(ends), np.int64), np.array(ends, np.int64))
    return h ^ _SALT[:len(h)] if len(h) == 1 else np.concatenate([h[:1] ^ _SALT[:1], h[1:] ^ _SALT[1]])


_SALT = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)  # whole words, beginnings


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, object]:
    """(row, hash) of every word and beginning in a chunk (with repeats)."""
    w = chunk.words(ALNUM_WORD)
    row = w.rows()
    rows, hashes = [row], [w.hashes() ^ _SALT[0]]
    for k in BEGINNINGS:
        long = np.flatnonzero(w.ends - w.starts > k)
        rows.append(row[long])
        hashes.append(span_hashes(w.data, w.starts[long], w.starts[long] + k) ^ _SALT[1])
    return np.concatenate(rows), np.concatenate(hashes), w


def _present(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[first], h[first]


@dataclass
class Model:
    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, chunk: Chunk, index: HashIndex) -> np.ndarray:
        rows, hashes, _ = _features(chunk)
        at = index.find(hashes)
        some = np.flatnonzero(at >= 0)
        pairs = np.unique(rows[some] * len(self.keys) + at[some]) if len(some) else np.zeros(0, np.int64)
        z = self.bias + np.bincount(pairs // max(len(self.keys), 1), self.weights[pairs % max(len(self.keys), 1)], minlength=chunk.n)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def swap_differences(terms=None) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(term, its features, features of the swapped-in term) for every swap."""
    out = []
    for groups in (terms or IDENTITY_TERMS).values():
        for group in groups:
            for a in group[1:]:
                out += [(a, _term_hashes(a), _term_hashes(b)) for b in group if b != a]
    return out


def _statistics(sample: DataFrame, min_docs: int) -> DataFrame:
    """(hash, bad, good): labelled documents of each class that hold a feature."""

    def one(chunk: Chunk):
        rows, hashes = _present(*_features(chunk)[:2])
        y = np.array(chunk.column("_label"))[rows]
        keys, at = np.unique(hashes, return_inverse=True)
        bad = np.bincount(at, y == 1, minlength=len(keys)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(keys)) - bad)],
                                          names=["hash", "bad", "good"])

    part = map_chunks(sample.select("_label", "_text"), "hash long, bad long, good long", one, "_text")
    return part.groupBy("hash").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") + F.col("good") >= min_docs)


def _select(stats: DataFrame, n_bad: int, n_good: int, min_gain: float) -> np.ndarray:
    """Hashes of all features that stand for the toxic class with a log-likelihood
    ratio of at least ``min_gain``.  They come from the bounded sample, so their number is
    bounded by its words."""
    total = float(n_bad + n_good)
    seen = F.col("bad") + F.col("good")

    def part(k, n):
        expected = seen * (n / total)
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    gain = part(F.col("bad"), n_bad) + part(F.col("good"), n_good)
    toxic = stats.where((F.col("bad") > seen * (n_bad / total)) & (gain >= min_gain))
    return np.sort(np.array(toxic.select("hash").toArrow().column("hash"), np.int64).view(np.uint64))


def _sentence_mentions(chunk: Chunk, index: HashIndex) -> np.ndarray:
    """Number of sentences of the chunk that mention each term of the index."""
    s = chunk.words(_NOT_SENTENCE_END)
    w = chunk.words(ALNUM_WORD)
    at = index.find(w.hashes())
    some = np.flatnonzero(at >= 0)
    sentence = np.searchsorted(s.starts, w.starts[some], "right")
    pairs = np.unique(sentence * max(len(index.keys), 1) + at[some])
    return np.bincount(pairs % max(len(index.keys), 1), minlength=len(index.keys))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS, min_docs: int = 3, min_gain: float = 2.0, penalty: float = 1.0, l1: float = 1e-4,
        l2: float = 1e-6, terms: dict | None = None) -> Model | None:
    """Fits on the bounded labelled sample, which is stored once.  Feature statistics are
    aggregated in Spark; the driver gets the features of the sample's rows that at least
    ``min_docs`` of them hold and that tell the classes apart by ``min_gain`` nats.  None if a class is missing."""
    sample = training_sample(docs, labels, label, id_col, text, per_class).select(F.col("_label").cast("int"), "_text")
    with stored(sample) as rows:
        return _fit(rows, min_docs, min_gain, penalty, l1, l2, terms)


def _fit(sample: DataFrame, min_docs: int, min_gain: float, penalty: float, l1: float, l2: float, terms: dict | None) -> Model | None:
    swaps = swap_differences(terms)
    names = sorted({t for t, _, _ in swaps})
    name_hash = np.array([span_hashes(np.frombuffer(t.encode(), np.uint8), np.zeros(1, int), np.array([len(t.encode())]))[0] for t in names],
                         np.uint64)
    classes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    n_bad, n_good = classes.get(1, 0), classes.get(0, 0)
    if not n_bad or not n_good:
        return None
    chosen = _select(_statistics(sample, min_docs), n_bad, n_good, min_gain)
    keys = np.unique(np.concatenate([chosen, *[h for _, a, b in swaps for h in (a, b)]]))
    index, mentions = HashIndex(keys), HashIndex(name_hash)

    def one(chunk: Chunk):
        rows, hashes, _ = _features(chunk)
        at = index.find(hashes)
        some = at >= 0
        pairs = np.unique(rows[some] * len(keys) + at[some])
        lists = [[] for _ in range(chunk.n)]
        for r, f in zip((pairs // len(keys)).tolist(), (pairs % len(keys)).tolist()):
            lists[r].append(f)
        said = np.zeros((chunk.n, len(names)), np.int32)
        if chunk.n:
            said[0] = _sentence_mentions(chunk, mentions)
        return pa.RecordBatch.from_arrays([chunk.column("_label"), pa.array(lists, pa.list_(pa.int32())),
                                           pa.array([x.tolist() if x.any() else [] for x in said], pa.list_(pa.int32()))],
                                          names=["y", "f", "said"])

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("f", ints), T.StructField("said", ints)])
    got = map_chunks(sample, schema, one, "_text").toArrow()
    y = np.array(got.column("y")).astype(float)
    lists = got.column("f").combine_chunks()
    counts = np.diff(np.array(lists.offsets))
    flat = np.array(lists.flatten(), np.int64)
    said = np.zeros(len(names))
    for x in got.column("said").to_pylist():
        if x:
            said += x
    delta = _swap_matrix(swaps, names, said, keys)
    w, bias = _minimise(flat, np.repeat(np.arange(len(y)), counts), y, len(keys), delta, penalty, l1, l2)
    keep = w > 1e-4
    return Model(keys[keep], w[keep], bias)


def _swap_matrix(swaps, names, said, keys) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of feature changes (entry row, feature, value) and the weight
    of each row: its share of the labelled sentences that can be swapped so."""
    number = dict(zip(names, said.tolist()))
    rows, cols, vals, weight = [], [], [], []
    for term, a, b in swaps:
        if number[term] > 0:
            for h, v in ((a, -1.0), (b, 1.0)):
                cols += np.searchsorted(keys, h).tolist()
                rows += [len(weight)] * len(h)
                vals += [v] * len(h)
            weight.append(number[term])
    weight = np.array(weight, float)
    return np.array(rows, np.int64), np.array(cols, np.int64), np.array(vals), weight / max(weight.sum(), 1)


def _minimise(flat, row, y, p, delta, penalty, l1, l2, steps: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on class-balanced logistic loss + L1 + L2 +
    swap penalty, weights at least zero, features scaled by their curvature."""
    n = len(y)
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    d_row, d_col, d_val, d_weight = delta
    curve = np.bincount(flat, weight[row], minlength=p) + 1e-4
    if len(d_weight):
        curve += 8 * penalty * np.bincount(d_col, d_weight[d_row] * d_val ** 2, minlength=p)
    scale = 1 / np.sqrt(curve)                                 # diagonal preconditioner
    per_row = np.bincount(row, scale[flat] ** 2, minlength=n)
    lip = 0.25 * (weight * (per_row + 1)).sum() / 4 + l2 * (scale ** 2).max()
    if len(d_weight):
        lip += 2 * penalty * (np.bincount(d_row, (d_val * scale[d_col]) ** 2, minlength=len(d_weight)) * d_weight).sum()

    def loss_grad(v, b):
        u = v * scale
        z = b + np.bincount(row, u[flat], minlength=n)
        prob = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        r = weight * (prob - y)
        g = np.bincount(flat, r[row], minlength=p) + l2 * u
        loss = (weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum() + l2 / 2 * u @ u
        if len(d_weight):
            change = np.bincount(d_row, d_val * u[d_col], minlength=len(d_weight))
            g += 2 * penalty * np.bincount(d_col, d_val * (d_weight * change)[d_row], minlength=p)
            loss += penalty * (d_weight * change ** 2).sum()
        return loss, g * scale, r.sum()

    v, b, old_v, old_b, t = np.zeros(p), 0.0, np.zeros(p), 0.0, 1.0
    lip = max(lip / 50, 1e-3)
    for _ in range(steps):
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yv, yb = v + (t - 1) / t_new * (v - old_v), b + (t - 1) / t_new * (b - old_b)
        loss, g, gb = loss_grad(yv, yb)
        while True:
            nv, nb = np.maximum(yv - (g + l1 * scale) / lip, 0), yb - gb / lip
            dv, db = nv - yv, nb - yb
            if loss_grad(nv, nb)[0] <= loss + g @ dv + gb * db + lip / 2 * (dv @ dv + db * db) + 1e-12 or lip > 1e9:
                break
            lip *= 2
        old_v, old_b, v, b, t = v, b, nv, nb, t_new
        lip *= 0.95
    return v * scale, float(b)


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted): every row is scored from its whole text
    alone.  Null and empty texts score as texts without words; repeated rows score
    alike; without labels of both classes (model None) every score is 0."""
    src = docs.select(F.col(id_col), held_out(id_col).alias("_held"), F.col(text).alias("_text"))

    def one(chunk: Chunk, index):
        s = np.zeros(chunk.n) if model is None else model.score(chunk, index)
        return pa.RecordBatch.from_arrays([chunk.column(id_col), chunk.column("_held"), pa.array(s),
                                           pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_chunks(src, schema, one, "_text", lambda: None if model is None else HashIndex(model.keys))
