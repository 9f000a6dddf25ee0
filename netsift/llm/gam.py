"""Quality classifier: a generalised additive model with pairwise interactions.

*Features* of a whole text, dense and independent of language: length, word length, shares
of capitals, digits, symbols and other byte classes, words that end in symbols, repeated
words, windows and lines, line and sentence lengths.

*Model.* Each feature is cut into quantile bins. Boosting goes round the features in
turn (cyclic) and fits a shallow tree of one feature at a time to the log-loss gradients; a
tree is piecewise constant over bins, so it is added to that feature's lookup table. Then
the residual gain of every pair of features is estimated on coarse bins, and for the best
pairs the same cyclic boosting fits trees of two features, added to pair tables. Rounds
stop by the loss of a held-back fold. A score is an intercept plus one table entry per
feature and pair: vectorised bin additions, then a logistic function.

It is fitted in NumPy on the driver on a bounded sample: at most ``per_class`` training
rows of each class, chosen by a hash of the id (a documented bound); executors send
features, never texts. Sampled rows weigh as their class does among all training rows.
Everything else covers all rows.

Edge cases: a null text scores as an empty text; several labels of an id count by the
largest; without labels of both classes the score is the share of label 1 (0 without any);
repeated rows are each scored, equal texts are one training row; an empty table gives an
empty result; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .langid import sample_ids
from .textops import (FOLD, Chunk, byte_class, doc_index, mix64, prefix_hash, runs, span_hash, sums, text_chunks)

SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
WORD = 1 - SPACE
UPPER = byte_class([(65, 90)])
LOWER = byte_class([(97, 122)])
DIGIT = byte_class([(48, 57)])
HIGH = byte_class([(0x80, 0xFF)])
CODE_POINT = 1 - byte_class([(0x80, 0xBF)])
SYMBOL = byte_class([(ord(x), ord(x)) for x in "#$%&*|<>@^~_=+\\{}[]"])
STOP = byte_class([(ord(x), ord(x)) for x in ".!?"])
COMMA = byte_class([(ord(x), ord(x)) for x in ",;:"])
EXCLAIM = byte_class([(33, 33)])
NOT_NEWLINE = 1 - byte_class([(10, 10)])

FEATURES = ["words_log", "word_length", "word_length_spread", "upper", "digits", "symbols", "high_bytes", "commas", "stops",
            "exclaims", "capital_words", "symbol_ends", "stop_ends", "distinct_words", "repeat_pairs", "repeat_windows",
            "most_frequent", "lines_log", "line_words", "repeat_lines", "short_words", "long_words"]
COARSE = 8  # bins a side in the search for pairs


def _per(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return sums(values.astype(np.int64), first)


def _distinct(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each row, and how often its most frequent one occurs."""
    n = len(first) - 1
    doc = doc_index(first)
    if not len(keys):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    both = np.sort(mix64(keys + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    # equal keys of a row are equal and stand together; their row is found again by the first of each
    value, count = np.unique(both, return_counts=True)
    of = np.empty(len(value), np.int64)
    of[np.searchsorted(value, mix64(keys + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))] = doc
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of, count)
    return np.bincount(of, minlength=n), most


def _windows(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the runs of ``n`` words inside each row, and the first-key index of each row."""
    size = np.maximum(np.diff(first) - (n - 1), 0)
    cut = np.concatenate([[0], np.cumsum(size)])
    if not cut[-1]:
        return np.zeros(0, np.uint64), cut
    at = np.arange(cut[-1]) - np.repeat(cut[:-1] - first[:-1], size)
    key = np.zeros(len(at), np.uint64)
    for j in range(n):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[at + j]
    return key, cut


def features(c: Chunk) -> np.ndarray:
    """Dense features of each text, in the order of FEATURES."""
    buf = c.buf
    starts, ends = runs(c, WORD)
    first = c.per_doc(starts)
    words = np.diff(first)
    n = np.maximum(words, 1)
    s = prefix_hash(buf, FOLD)
    h = span_hash(s, starts, ends)

    def prefix(member: np.ndarray) -> np.ndarray:
        x = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(member[buf], out=x[1:])
        return x

    def share(member: np.ndarray) -> np.ndarray:
        x = prefix(member)
        return (x[c.offs[1:]] - x[c.offs[:-1]]) / size

    points = prefix(CODE_POINT)
    size = np.maximum(points[c.offs[1:]] - points[c.offs[:-1]], 1)
    length = points[ends] - points[starts]
    mean = _per(length, first) / n
    spread = np.sqrt(np.maximum(_per(length * length, first) / n - mean * mean, 0))
    lead = buf[starts] if len(starts) else buf[:0]
    last = buf[ends - 1] if len(ends) else buf[:0]
    before = buf[np.maximum(ends - 2, starts)] if len(ends) else buf[:0]
    kinds, most = _distinct(h, first)
    pairs, pair_first = _windows(h, first, 2)
    fives, five_first = _windows(h, first, 5)
    pair_kinds, _ = _distinct(pairs, pair_first)
    five_kinds, _ = _distinct(fives, five_first)
    ls, le = runs(c, NOT_NEWLINE)
    line_first = c.per_doc(ls)
    lines = np.diff(line_first)
    line_kinds, _ = _distinct(span_hash(s, ls, le), line_first)

    def repeats(kinds: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return 1 - kinds / np.maximum(np.diff(cut), 1) * (np.diff(cut) > 0) - (np.diff(cut) == 0)

    return np.column_stack([
        np.log1p(words), mean, spread, share(UPPER), share(DIGIT), share(SYMBOL), share(HIGH), share(COMMA), share(STOP),
        share(EXCLAIM), _per(UPPER[lead], first) / n, _per(SYMBOL[last] | EXCLAIM[last] & EXCLAIM[before], first) / n,
        _per(STOP[last], first) / n, kinds / n, repeats(pair_kinds, pair_first), repeats(five_kinds, five_first), most / n,
        np.log1p(lines), np.log1p(words / np.maximum(lines, 1)), repeats(line_kinds, line_first),
        _per(length <= 2, first) / n, _per(length >= 12, first) / n])


# ---------------------------------------------------------------------------
# The model
# ---------------------------------------------------------------------------


@dataclass
class Gam:
    """An intercept, a lookup table per feature, and a table per pair of features."""
    share: float
    intercept: float = 0.0
    cuts: list = field(default_factory=list)         # ascending bin edges of each feature
    tables: list = field(default_factory=list)       # one value per bin
    pairs: list = field(default_factory=list)        # (feature, feature)
    pair_cuts: list = field(default_factory=list)    # coarse edges of each feature
    pair_tables: list = field(default_factory=list)  # COARSE x COARSE values

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (cut, t) in enumerate(zip(self.cuts, self.tables)):
            z += t[np.searchsorted(cut, x[:, f], "left")]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            z += t[np.searchsorted(self.pair_cuts[a], x[:, a], "left"), np.searchsorted(self.pair_cuts[b], x[:, b], "left")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def edges(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` - 1 quantile edges; bin i holds edge[i - 1] < x <= edge[i]."""
    return np.unique(np.quantile(x, np.linspace(0, 1, n + 1)[1:-1], method="lower"))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float, min_h: float) -> tuple[float, int]:
    """Gain and place of the best split of binned gradient sums (0, -1: none)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gs, hs = g.sum(), h.sum()
    gain = gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs ** 2 / (hs + ridge)
    gain = np.where((hl < min_h) | (hs - hl < min_h), 0, gain)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, -1
    return float(gain.max()), int(gain.argmax())


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, min_h: float) -> np.ndarray:
    """Values per bin of a tree with at most ``leaves`` leaves, grown by the best split."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        tried = [(*_best_cut(g[a:b], h[a:b], ridge, min_h), a, b) for a, b in parts]
        gain, at, a, b = max(tried)
        if at < 0:
            break
        parts.remove((a, b))
        parts += [(a, a + at + 1), (a + at + 1, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, ridge: float, min_h: float) -> tuple[float, np.ndarray]:
    """Gain and values of a tree with one cut on an axis and a cut of the other on each side."""
    best = (0.0, np.zeros(g.shape))
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for i in range(1, len(gg)):
            out, total = np.zeros(gg.shape), -whole
            for side in (slice(0, i), slice(i, None)):
                gs, hs = gg[side].sum(axis=0), hh[side].sum(axis=0)
                _, at = _best_cut(gs, hs, ridge, min_h)
                for cut in ((slice(None),) if at < 0 else (slice(0, at + 1), slice(at + 1, None))):
                    a, b = gs[cut].sum(), hs[cut].sum()
                    out[side, cut] = -a / (b + ridge)
                    total += a * a / (b + ridge)
            if total > best[0] + 1e-9:
                best = (float(total), out if axis == 0 else out.T)
    return best


def _loss(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    return float((w * (np.logaddexp(0, z) - y * z)).sum() / w.sum())


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, n_bins: int = 64, n_pairs: int = 8,
          rounds: int = 150, rate: float = 0.1, leaves: int = 3, ridge: float = 1.0, min_h: float = 1.0,
          patience: int = 15) -> Gam:
    """Cyclic boosting of feature tables, then of the tables of the best pairs.

    ``held`` marks the fold whose loss decides how many rounds are kept.
    """
    k = x.shape[1]
    p = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
    cuts = [edges(x[:, f], n_bins) for f in range(k)]
    coarse = [edges(x[:, f], COARSE) for f in range(k)]
    bins = [np.searchsorted(cuts[f], x[:, f], "left") for f in range(k)]
    model = Gam(float(p), float(np.log(p / (1 - p))), cuts, [np.zeros(len(c) + 1) for c in cuts], [], coarse, [])
    use = ~held
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-z))
        return (w * (q - y))[use], np.maximum(w * q * (1 - q), 1e-9)[use]

    def rounds_of(tables: list, step, index: list) -> None:
        """Add steps to ``tables`` in turn; keep the round with the least held-back loss."""
        nonlocal z
        best, kept, waited, start = _loss(z[held], y[held], w[held]), [t.copy() for t in tables], 0, z.copy()
        for _ in range(rounds):
            for j in range(len(tables)):
                add = rate * step(j)
                tables[j] += add
                z = z + add[index[j]]
            now = _loss(z[held], y[held], w[held])
            if now < best - 1e-6:
                best, kept, waited = now, [t.copy() for t in tables], 0
            else:
                waited += 1
                if waited >= patience:
                    break
        z = start
        for j, t in enumerate(kept):
            tables[j][...] = t
            z = z + t[index[j]]

    def main(f: int) -> np.ndarray:
        g, h = slopes()
        n = len(cuts[f]) + 1
        return shallow_tree(np.bincount(bins[f][use], g, n), np.bincount(bins[f][use], h, n), leaves, ridge, min_h)

    rounds_of(model.tables, main, bins)

    wide = [np.searchsorted(coarse[f], x[:, f], "left") for f in range(k)]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        at = wide[a][use] * COARSE + wide[b][use]
        return tuple(np.bincount(at, v, COARSE * COARSE).reshape(COARSE, COARSE) for v in (g, h))

    gains = [(pair_tree(*grid(a, b), ridge, min_h)[0], a, b) for a in range(k) for b in range(a + 1, k)]
    model.pairs = [(a, b) for gain, a, b in sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    rounds_of(model.pair_tables, lambda j: pair_tree(*grid(*model.pairs[j]), ridge, min_h)[1],
              [(wide[a], wide[b]) for a, b in model.pairs])
    # centred tables: the intercept carries the mean
    for j, t in enumerate(model.tables):
        mean = (w * t[bins[j]]).sum() / w.sum()
        t -= mean
        model.intercept += mean
    return model


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", per_class: int = 3000, seed: int = 12) -> Gam:
    """Fit on labelled rows that ``trainable`` (over ``doc_id``) selects."""
    known = (labels.filter(trainable & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
             .filter(F.col("y").isin(0, 1)))
    of = {int(r["y"]): r["count"] for r in known.groupBy("y").count().toArrow().to_pylist()}
    share = of.get(1, 0) / max(sum(of.values()), 1)
    ids = persisted(sample_ids(known, "id", "y", per_class, seed))
    # at most 2 * per_class ids, so safe to broadcast; equal texts are one training row
    sample = (docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
              .join(F.broadcast(ids), "id").withColumn("key", F.xxhash64("t")).select("t", "y", "key"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in text_chunks(b.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(c.lo, c.n_docs), b.column(2).slice(c.lo, c.n_docs),
                     pa.array(list(features(c)), pa.list_(pa.float64()))], names=["y", "key", "x"])

    rows = (sample.mapInArrow(go, "y int, key long, x array<double>").groupBy("key")
            .agg(F.max(F.struct("y", "x")).alias("r")).select("key", "r.y", "r.x").toArrow().to_pylist())
    rows.sort(key=lambda r: r["key"])  # whatever the partitioning
    y = np.array([r["y"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Gam(share)
    x = np.array([r["x"] for r in rows])
    w = np.where(y == 1, of[1] / y.sum(), of[0] / (1 - y).sum())
    held = mix64(np.array([r["key"] for r in rows], np.int64).view(np.uint64)) % np.uint64(5) == 0
    if not (0 < y[held].sum() < held.sum() and 0 < y[~held].sum() < (~held).sum()):
        held = np.zeros(len(y), bool)
        held[[int(np.flatnonzero(y == v)[0]) for v in (0, 1)]] = True  # too few rows for a fold
    return boost(x, y, w / w.mean(), held)


def score(docs: DataFrame, model: Gam, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of each row of ``docs``; only the id and the text are read."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for c in text_chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.lo, c.n_docs), pa.array(m.score(features(c)))],
                                                 names=["doc_id", "score"])

    return src.mapInArrow(go, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")
