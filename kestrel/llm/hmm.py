"""Hidden Markov language model over documents.

Alphabet: the ``top`` most frequent training words each have a symbol, all other
words share ``BUCKETS`` symbols by their ending, and every text closes with an end
symbol.  The alphabet bounds the model, not the data: the probability of a rarer
word within its bucket comes from its own count, (c + 1) / (N_b + V_b + 1), and
word counts are kept for the whole vocabulary in a table that is
joined, never broadcast.

Training: Baum-Welch.  Each task runs forward and backward recursions over its
documents and adds up expected starts, transitions and emissions; the counts are
summed over all partitions and give the next parameters.  Every round reads all training
documents; rounds go on until the log likelihood gains less than ``tolerance`` a token (or
for a given number of ``steps``).  Rounds on a bounded sample before them are an option, off
by default.

Recursions are exact for whole texts of any length.  A text is cut into blocks of
``BLOCK`` tokens whose transfer matrices are multiplied up side by side;
chaining them gives the scaled forward (backward) vector at each block's edge, from
which the vectors inside all blocks are again computed side by side."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.labelled import held_out
from kestrel.llm.textkit import SPACE_WORD, Chunk, HashIndex, Words, chunks, list_column, map_chunks
from kestrel.operators.evaluate import running_totals
from kestrel.session import cut_lineage

TOP, BUCKETS, STATES = 60_000, 512, 4
BLOCK, PIECE_TOKENS, FLUSH_WORDS = 64, 400_000, 1_500_000
TOLERANCE = 1e-3    # nats a token


# ---- vocabulary --------------------------------------------------------
def _bucket(w: Words, at: np.ndarray) -> np.ndarray:
    """Symbol bucket of words by their last two bytes."""
    last = w.data[w.ends[at] - 1].astype(np.int64)
    before = w.data[np.maximum(w.ends[at] - 2, w.starts[at])].astype(np.int64)
    return (last * 37 + before) % BUCKETS


def word_counts(src: DataFrame) -> DataFrame:
    """(h, bucket, c) of every word of the texts ``_text``, summed in each task
    before the shuffle."""

    def run(batches):
        held: list[tuple] = []

        def merged():
            h, b, c = (np.concatenate(x) for x in zip(*held))
            keys, first, back = np.unique(h, return_index=True, return_inverse=True)
            return keys, b[first], np.bincount(back, c).astype(np.int64)

        def batch(h, b, c):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(b.astype(np.int32)), pa.array(c)], names=["h", "bucket", "c"])

        for rows in batches:
            for chunk in chunks(rows, "_text"):
                w = chunk.words(SPACE_WORD)
                keys, first, n = np.unique(w.hashes(), return_index=True, return_counts=True)
                held.append((keys, _bucket(w, first), n))
                if sum(len(x[0]) for x in held) > FLUSH_WORDS:
                    held = [merged()]
                    if len(held[0][0]) > FLUSH_WORDS // 2:
                        yield batch(*held.pop())
        if held:
            yield batch(*merged())

    return src.select("_text").mapInArrow(run, "h long, bucket int, c long").groupBy("h").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    keys: np.ndarray       # hashes of the top words
    counts: np.ndarray     # their counts
    bucket_total: np.ndarray  # N_b + V_b + 1 of each bucket
    bucket_count: np.ndarray  # N_b
    n_docs: int
    n_tokens: int          # N: words and ends
    n_types: int           # V

    @property
    def size(self) -> int:
        return len(self.keys) + BUCKETS + 1

    @property
    def end(self) -> int:
        return self.size - 1

    @property
    def denominator(self) -> int:
        return self.n_tokens + self.n_types + 1


_BINS = 256


def _cutoff(counts: DataFrame, top: int) -> tuple[int, int]:
    """(c, n): words above count c number at most ``top``, n more may be taken of those
    with just that count.  Histograms of ``_BINS`` bins narrow down c."""
    low, high, left = 1, (counts.agg(F.max("c")).first()[0] or 0) + 1, top
    while high - low > 1:   # words of count ``high`` and above are in
        width = -(-(high - low) // _BINS)
        inside = counts.where((F.col("c") >= low) & (F.col("c") < high))
        bins = inside.groupBy(F.floor((F.col("c") - low) / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        for number, n in sorted(map(tuple, bins.collect()), reverse=True):
            if n > left:
                low, high = low + number * width, min(high, low + (number + 1) * width)
                break
            left -= n
        else:
            return 0, 0
    return low, left


def vocabulary(counts: DataFrame, n_docs: int, top: int) -> Vocabulary:
    """Top words and totals: at most ``top`` + BUCKETS rows reach the driver.  Words above
    a cutoff count are taken, of those with just that count the ones of smallest hash
    (ranked by range partitions), so that no task gathers the candidates of all others."""
    least, short = _cutoff(counts, top)
    best = counts.where(F.col("c") > least).select("h", "c")
    if short:
        equal = counts.where(F.col("c") == least).select("h", "c", F.lit(1).alias("one"))
        best = best.unionByName(running_totals(equal, [], "h", ["one"], descending=False).where(F.col("cum_one") <= short).select("h", "c"))
    best = best.toArrow().sort_by([("c", "descending"), ("h", "ascending")])
    keys, c = np.array(best.column("h"), np.int64), np.array(best.column("c"), np.int64)
    per = {r["bucket"]: (r["n"], r["v"]) for r in counts.groupBy("bucket").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n, v = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b, (x, y) in per.items():
        n[b], v[b] = x, y
    total, types = int(n.sum()), int(v.sum())
    if len(keys):  # the top words leave their buckets
        kept = counts.join(F.broadcast(counts.sparkSession.createDataFrame(pa.table({"h": best.column("h")}))), "h")
        for r in kept.groupBy("bucket").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            n[r["bucket"]] -= r["n"]
            v[r["bucket"]] -= r["v"]
    return Vocabulary(keys.view(np.uint64), c, n + v + 1, n, n_docs, total + n_docs, types + (n_docs > 0))


# ---- encoding ----------------------------------------------------------
def _symbols(chunk: Chunk, voc: Vocabulary, index: HashIndex) -> tuple[Words, np.ndarray, np.ndarray]:
    w = chunk.words(SPACE_WORD)
    h = w.hashes()
    sym = index.find(h)
    rare = np.flatnonzero(sym < 0)
    sym[rare] = len(voc.keys) + _bucket(w, rare)
    return w, h, sym


def encoded(src: DataFrame, voc: Vocabulary) -> DataFrame:
    """(_key, _train, n, known, base, inside, ids): symbols of each text and the
    parts of the sums that need no join - top words, ends, bucket totals."""
    shared = src.sparkSession.sparkContext.broadcast(voc)
    log_c = np.log10(voc.counts + 1.0)
    log_bucket = np.log10(voc.bucket_total.astype(float))

    def one(chunk: Chunk, state):
        voc, index = state
        w, _, sym = _symbols(chunk, voc, index)
        rows, k = w.rows(), len(voc.keys)
        top = sym < k
        flat = np.full(len(w) + chunk.n, voc.end, np.uint16)
        flat[np.arange(len(w)) + rows] = sym
        size = w.counts + 1
        known = np.bincount(rows[top], minlength=chunk.n) + (voc.n_docs > 0)
        base = np.bincount(rows[top], log_c[sym[top]], minlength=chunk.n) + np.log10(voc.n_docs + 1.0)
        inside = -np.bincount(rows[~top], log_bucket[sym[~top] - k], minlength=chunk.n)
        off = np.zeros(chunk.n + 1, np.int32)
        np.cumsum(size * 2, out=off[1:])
        ids = pa.Array.from_buffers(pa.binary(), chunk.n, [None, pa.py_buffer(off), pa.py_buffer(flat)])
        return pa.RecordBatch.from_arrays([chunk.column("_key"), chunk.column("_train"), pa.array(size, pa.int64()), pa.array(known, pa.int64()),
                                           pa.array(base, pa.float64()), pa.array(inside, pa.float64()), ids], names=schema.names)

    long, double = T.LongType(), T.DoubleType()
    schema = T.StructType([T.StructField("_key", long), T.StructField("_train", T.BooleanType()), T.StructField("n", long), T.StructField("known", long),
                           T.StructField("base", double), T.StructField("inside", double), T.StructField("ids", T.BinaryType())])
    return map_chunks(src, schema, one, "_text", lambda: (shared.value, HashIndex(shared.value.keys)))


def rare_sums(src: DataFrame, voc: Vocabulary, counts: DataFrame) -> DataFrame:
    """(_key, log_c, seen): over the words of each text that have no own symbol,
    the sum of log10(c + 1) and the number with c > 0, by a join with the
    counts of the whole vocabulary (texts with such words only; rows repeated in full add up)."""
    shared = src.sparkSession.sparkContext.broadcast(voc)

    def one(chunk: Chunk, state):
        voc, index = state
        w, h, sym = _symbols(chunk, voc, index)
        rare = np.flatnonzero(sym >= len(voc.keys))
        row, h = w.rows()[rare], h[rare]
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(row)))
        per = np.bincount(row[at], minlength=chunk.n)
        return pa.RecordBatch.from_arrays([chunk.column("_key"), list_column(h[at].view(np.int64), per, pa.int64()),
                                           list_column(times.astype(np.int32), per, pa.int32())], names=["_key", "h", "tf"])

    pairs = map_chunks(src.select("_key", "_text"), "_key long, h array<long>, tf array<int>", one, "_text",
                       lambda: (shared.value, HashIndex(shared.value.keys)))
    flat = pairs.select("_key", F.explode(F.arrays_zip("h", "tf")).alias("x")).select("_key", "x.h", "x.tf")
    j = flat.join(counts.select("h", "c"), "h")
    return j.groupBy("_key").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("log_c"), F.sum("tf").alias("seen"))


# ---- recursions --------------------------------------------------------
@dataclass
class Model:
    start: np.ndarray   # K
    move: np.ndarray    # K x K
    emit: np.ndarray    # symbols x K


class Blocks:
    """Sequences cut into blocks, longest blocks first, so that the blocks still
    running at step t are a prefix."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        per = -(-size // BLOCK)
        self.n_seq, self.per = len(size), per
        seq = np.repeat(np.arange(len(size)), per)
        place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        length = np.minimum(size[seq] - place * BLOCK, BLOCK)
        begin = (np.cumsum(size) - size)[seq] + place * BLOCK
        order = np.argsort(-length, kind="stable")
        self.order, self.length, self.begin, self.flat = order, length[order], begin[order], flat
        self.first = place[order] == 0
        self.running = np.searchsorted(-self.length, -np.arange(BLOCK), "left")   # blocks longer than t
        # for chaining: block number (in sorted order) of the j-th block of each sequence
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.arange(len(order))
        self.head = np.cumsum(per) - per

    def chain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sequences, their j-th blocks) for j = 0, 1, ..."""
        live = np.arange(self.n_seq)
        j = 0
        while True:
            live = live[self.per[live] > j]
            if not len(live):
                return
            yield live, self.number[self.head[live] + j]
            j += 1

    def steps(self) -> Iterator[slice]:
        """For t = 0, 1, ...: place of the t-th symbols of the running blocks in ``by_step``."""
        a = 0
        for n in self.running:
            if not n:
                return
            yield slice(a, a + n)
            a += n

    def by_step(self) -> np.ndarray:
        """All symbols, step by step."""
        return np.concatenate([self.flat[self.begin[:n] + t] for t, n in enumerate(self.running)])


# Arrays over blocks have the blocks on the last axis: sums over states are then
# additions of long rows.
def transfers(b: Blocks, m: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transfer matrix of each block (from x to x blocks), scaled, and the logarithm of its scale."""
    x = np.where(b.first, m.start[None, :, None], m.move[:, :, None]) * emitted[None, :, :len(b.first)]
    log = np.zeros(len(b.first))
    for t, at in enumerate(b.steps()):
        if not t:
            continue
        n = at.stop - at.start
        y = np.matmul(m.move.T, x[:, :, :n])
        y *= emitted[:, at]
        if t % 12 == 0 or t == BLOCK - 1:
            s = y.max(axis=(0, 1))
            y /= s
            log[:n] += np.log(s)
        x[:, :, :n] = y
    s = x.max(axis=(0, 1))
    return x / s, log + np.log(s)


def forward(b: Blocks, m: Model, x: np.ndarray, log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood of each sequence, forward vector before each block)."""
    k = len(m.start)
    v = np.full((k, b.n_seq), 1.0 / k)
    total, before = np.zeros(b.n_seq), np.empty((k, len(log)))
    for live, block in b.chain():
        before[:, block] = v[:, live]
        u = np.einsum("kn,kjn->jn", v[:, live], x[:, :, block])
        s = u.sum(0)
        v[:, live] = u / s
        total[live] += np.log(s) + log[block]
    return total, before


def log_likelihood(flat: np.ndarray, size: np.ndarray, m: Model) -> np.ndarray:
    """Natural log likelihood of each symbol sequence (scaled forward recursion)."""
    if not len(size):
        return np.zeros(0)
    b = Blocks(flat, size)
    return forward(b, m, *transfers(b, m, np.ascontiguousarray(m.emit.T)[:, b.by_step()]))[0]


def expected_counts(flat: np.ndarray, size: np.ndarray, m: Model, start, move, emit) -> float:
    """Adds the expected counts of the sequences to start (K), move (K x K) and
    emit (K x symbols); returns their natural log likelihood."""
    k, b = len(m.start), Blocks(flat, size)
    symbols = b.by_step()
    emitted = np.ascontiguousarray(m.emit.T)[:, symbols]
    x, log = transfers(b, m, emitted)
    total, before = forward(b, m, x, log)
    after = np.ones((k, len(log)))
    links = list(b.chain())
    for (_, _), (live, nxt) in zip(reversed(links[:-1]), reversed(links[1:])):
        here = b.number[b.head[live] + b_index(b, live, nxt) - 1]
        u = np.einsum("kjn,jn->kn", x[:, :, nxt], after[:, nxt])
        after[:, here] = u / u.sum(0)
    alphas = np.empty_like(emitted)
    steps = list(b.steps())
    for t, at in enumerate(steps):
        n = at.stop - at.start
        if t:
            a = (m.move.T @ alphas[:, steps[t - 1].start:steps[t - 1].start + n]) * emitted[:, at]
        else:
            a = np.where(b.first, m.start[:, None], m.move.T @ before) * emitted[:, at]
        alphas[:, at] = a / a.sum(0)
    beta = after
    share = np.empty_like(emitted)   # of each state in each symbol
    for t in range(len(steps) - 1, -1, -1):
        at = steps[t]
        n = at.stop - at.start
        g = alphas[:, at] * beta[:, :n]
        g /= g.sum(0)
        share[:, at] = g
        eb = emitted[:, at] * beta[:, :n]
        back = m.move @ eb
        if t:
            prev = alphas[:, steps[t - 1].start:steps[t - 1].start + n]
            move += m.move * ((prev / (prev * back).sum(0)) @ eb.T)
            beta[:, :n] = back / back.sum(0)
        else:
            inner = ~b.first
            prev = before[:, inner]
            move += m.move * ((prev / (prev * back[:, inner]).sum(0)) @ eb[:, inner].T)
            start += g[:, b.first].sum(1)
    for i in range(k):
        emit[i] += np.bincount(symbols, share[i], minlength=emit.shape[1])
    return float(total.sum())


def b_index(b: Blocks, live: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Place of blocks (in sorted order) within their sequences."""
    return b.order[block] - b.head[live]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, symbols, sizes) with a bounded number of tokens."""
    col = batch.column(batch.schema.get_field_index("ids")).cast(pa.large_binary())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(col):
        e = max(a + 1, int(np.searchsorted(off, off[a] + 2 * PIECE_TOKENS, "right")) - 1)
        e = min(e, len(col))
        yield a, e, np.frombuffer(flat[off[a]:off[e]].tobytes(), np.uint16).astype(np.int64), np.diff(off[a:e + 1]) // 2
        a = e


# ---- training ----------------------------------------------------------
def baum_welch_step(rows: DataFrame, m: Model, prior: np.ndarray, smooth: float = 50.0) -> tuple[Model, float]:
    """One round: expected counts of all rows, summed over the partitions, then
    (new parameters, log likelihood a token under ``m``).  Emissions are smoothed towards
    the unigram ``prior``."""
    shared = rows.sparkSession.sparkContext.broadcast(m)
    k = len(m.start)
    names = [f"c{i}" for i in range(k)]

    def run(batches):
        m = shared.value
        start, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, len(m.emit))), np.zeros(k)
        for batch in batches:
            for _, _, flat, size in _pieces(batch):
                total[0] += expected_counts(flat, size, m, start, move, emit)
        some = np.flatnonzero(emit.sum(0))
        at = np.concatenate([[-1], -2 - np.arange(k), [-2 - k], some])
        c = np.vstack([start, move, total, emit.T[some]])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *[pa.array(c[:, i]) for i in range(k)]], names=["at", *names])

    part = rows.select("ids").mapInArrow(run, "at long, " + ", ".join(f"{n} double" for n in names))
    got = part.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    at = np.array(got.column("at"), np.int64)
    c = np.column_stack([np.array(got.column(n)) for n in names]) if len(at) else np.zeros((0, k))
    emit, start, move = np.zeros((len(prior), k)), np.full(k, 0.1), np.full((k, k), 0.1)
    emit[at[at >= 0]] = c[at >= 0]
    n_tokens, total = emit.sum(), 0.0
    for i, row in zip(at.tolist(), c):
        if i == -1:
            start = start + row
        elif i == -2 - k:
            total = row[0]
        elif i < -1:
            move[-2 - i] += row
    emit = (emit + smooth * prior[:, None]) / (emit.sum(0) + smooth)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit), float(total / n_tokens) if n_tokens else 0.0


def first_model(prior: np.ndarray, states: int) -> Model:
    """Sticky states whose emissions are the unigram with fixed random tilts."""
    tilt = np.random.default_rng(11).lognormal(0, 0.8, (len(prior), states))
    emit = prior[:, None] * tilt
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def train(rows: DataFrame, voc: Vocabulary, states: int, warm_rows: int, warm_steps: int, steps: int | None, tolerance: float) -> Model:
    prior = np.concatenate([voc.counts, voc.bucket_count, [voc.n_docs]]) + 1.0
    prior /= prior.sum()
    m = first_model(prior, states)
    if warm_steps:
        warm = cut_lineage(rows.select("_key", "ids").orderBy("_key").limit(warm_rows).select("ids").repartition(8))
        for _ in range(warm_steps):
            m, _ = baum_welch_step(warm, m, prior)
    done, before = 0, -np.inf
    while steps is None or done < steps:
        m, now = baum_welch_step(rows, m, prior)
        done += 1
        if steps is None and now - before < tolerance:
            break
        before = now
    return m


# ---- operator ----------------------------------------------------------
def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folds: int = 7, out: int = 2, top: int = TOP,
          states: int = STATES, warm_rows: int = 1_000, warm_steps: int = 0, steps: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows outside the hold-out fold: Baum-Welch over all of them until a round
    gains less than ``tolerance`` nats a token, or ``steps`` rounds if given.  base_score is the add-one
    unigram log10 probability, score the hidden Markov model's log10 probability of the whole
    text.  Null and empty texts are a lone end; repeated rows count and are
    scored each; without training rows every word is unseen and score equals the
    untrained model's.  An empty table gives an empty result; other columns are not
    read."""
    src = docs.select(F.col(id_col).alias("_id"), held_out(id_col, folds, out).alias("_held"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    src = src.select("_id", "_held", "_text", F.xxhash64("_id", "_text").alias("_key"))
    keyed = src.select("_key", (~F.col("_held")).alias("_train"), "_text")
    train_src = keyed.where("_train")
    counts = cut_lineage(word_counts(train_src))
    voc = vocabulary(counts, train_src.count(), min(top, 65_535 - BUCKETS - 1))
    rows = cut_lineage(encoded(keyed, voc))
    m = train(rows.where("_train"), voc, states, warm_rows, warm_steps, steps, tolerance)
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def run(batches):
        for batch in batches:
            for a, e, flat, size in _pieces(batch):
                part = batch.slice(a, e - a)
                cols = [part.column(part.schema.get_field_index(c)) for c in ("_key", "n", "known", "base", "inside")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(log_likelihood(flat, size, shared.value) / np.log(10))], names=names)

    names = ["_key", "n", "known", "base", "inside", "chain"]
    chained = rows.select("_key", "n", "known", "base", "inside", "ids") \
        .mapInArrow(run, "_key long, n long, known long, base double, inside double, chain double")
    # rows repeated in full have one key: their sums are equal, the join's are multiples
    per = chained.groupBy("_key").agg(*[F.first(c).alias(c) for c in names[1:]], F.count(F.lit(1)).alias("_same"))
    rare = rare_sums(keyed, voc, counts)
    j = per.join(rare, "_key", "left")
    log_c, seen = F.coalesce(F.col("log_c"), F.lit(0.0)) / F.col("_same"), F.coalesce(F.col("seen"), F.lit(0)) / F.col("_same")
    sums = j.select("_key", F.col("n").alias("n_tokens"), (F.col("known") + F.round(seen)).cast("long").alias("n_known"),
                    (F.col("base") + log_c - F.col("n") * float(np.log10(voc.denominator))).alias("base_score"),
                    (F.col("chain") + F.col("inside") + log_c).alias("score"))
    return src.select("_id", "_held", "_key").join(sums, "_key") \
        .select(F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "n_tokens", "n_known",
                F.lit(voc.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
