"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

*Features* of a whole text: lexicon densities (whole words and word stems, also after
undoing digit and symbol substitutions), nearness of second-person words to lexicon
words, shares of capitals and all-capital words, punctuation, exclamation and
obfuscation rates, length.

*Lexicon*: words and word beginnings (3 to 8 bytes) of the training sample whose
smoothed log-odds for toxic documents are above a limit, counted by document in one
aggregation; every such entry is kept. Training features use the lexicon of the other half of the sample
(cross-fitting), so that the trees see honest densities; the final lexicon uses all.

*Model*: histogram gradient boosting on log loss in NumPy on the driver, then isotonic
regression (pool adjacent violators) of out-of-fold scores, weighted back to the class
shares of all training rows. It is fitted on a bounded sample: at most ``per_class``
training rows of each class, chosen by a hash of the id (a documented bound). Everything
else covers all rows.

Edge cases: a null text scores as an empty text; null or contradictory labels (the
larger counts) never fail; without labels of both classes the score is the share of
toxic labels (0 without any); repeated rows are each scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .langid import sample_ids
from .textops import (FOLD, Chunk, byte_class, doc_index, hash_words, mix64, prefix_hash, runs, span_hash, sums,
                      text_chunks)

LETTER = byte_class([(65, 90), (97, 122), (0x80, 0xFF)])
# letters, digits and the symbols that stand for letters in disguised words
DISGUISE = byte_class([(48, 57), (65, 90), (97, 122), (0x80, 0xFF), (33, 33), (36, 36), (42, 42), (64, 64)])
UNDO = FOLD.copy()
for _from, _to in zip(b"013457@$!", b"oieastasi"):
    UNDO[_from] = _to
UPPER = byte_class([(65, 90)])
PUNCT = byte_class([(33, 47), (58, 64), (91, 96), (123, 126)])
EXCLAIM = byte_class([(33, 33), (63, 63)])
SPACE = byte_class([(32, 32), (9, 13)])

# fixed values: second-person words of the four languages
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "euch", "tu",
                 "te", "toi", "ton", "ta", "vous", "votre", "vos", "usted", "ustedes", "ti", "tus", "vosotros"]
STEMS = (3, 4, 5, 6, 7, 8)
MIN_ODDS = 2.0
NEAR = 5

FEATURES = ["hits_log", "hit_density", "max_odds", "odds_density", "stem_hits_log", "stem_density", "max_stem_odds",
            "disguised_density", "second_person_near", "second_person_density", "capitals", "all_caps", "punctuation",
            "exclaim", "obfuscated", "words_log"]


@dataclass
class Lexicon:
    """Sorted hashes of words and stems with their log-odds."""
    words: np.ndarray
    word_odds: np.ndarray
    stems: np.ndarray
    stem_odds: np.ndarray

    @staticmethod
    def lookup(keys: np.ndarray, odds: np.ndarray, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h))
        if len(keys):
            some = np.zeros(1 << 16, bool)  # by the low 16 bits: most hashes need no search
            some[keys & np.uint64(0xFFFF)] = True
            at = np.flatnonzero(some[h & np.uint64(0xFFFF)])
            k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            out[at] = np.where(keys[k] == h[at], odds[k], 0.0)
        return out


def _fold_accents(buf: np.ndarray) -> np.ndarray:
    """A-Z and the two-byte capitals of Latin-1 in lower case."""
    b = FOLD[buf]
    if len(b) > 1:
        up = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
        b[1:][up] += 0x20
    return b


def _words(c: Chunk):
    low = _fold_accents(c.buf)
    s = prefix_hash(low)
    starts, ends = runs(c, LETTER)
    return s, starts, ends, span_hash(s, starts, ends)


def _stem_hashes(s: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of the first ``k`` bytes of each word longer than that."""
    at = np.flatnonzero(ends - starts > k)
    # stems and whole words are different entries
    return at, mix64(span_hash(s, starts[at], starts[at] + k) + np.uint64(k))


def features(c: Chunk, lex: Lexicon, person: np.ndarray) -> np.ndarray:
    """Dense features of each text, in the order of FEATURES."""
    s, starts, ends, h = _words(c)
    first = c.per_doc(starts)
    n = np.maximum(np.diff(first), 1)
    doc = doc_index(first)
    odds = lex.lookup(lex.words, lex.word_odds, h)
    stem = np.zeros(len(h))
    for k in STEMS:
        at, hs = _stem_hashes(s, starts, ends, k)
        np.maximum.at(stem, at, lex.lookup(lex.stems, lex.stem_odds, hs))

    def most(v: np.ndarray) -> np.ndarray:
        out = np.zeros(c.n_docs)
        np.maximum.at(out, doc, v)
        return out

    def total(v: np.ndarray) -> np.ndarray:
        x = np.zeros(len(v) + 1)
        np.cumsum(v, out=x[1:])
        return x[first[1:]] - x[first[:-1]]

    hit = (odds > 0) | (stem > 0)
    you = np.isin(h, person)
    # lexicon words with a second-person word within NEAR words of the same text
    reach = np.zeros(len(h) + 1, np.int64)
    y = np.flatnonzero(you)
    lo = np.maximum(y - NEAR, first[doc[y]]) if len(y) else y
    hi = np.minimum(y + NEAR + 1, first[doc[y] + 1]) if len(y) else y
    np.add.at(reach, lo, 1)
    np.subtract.at(reach, hi, 1)
    near = hit & (np.cumsum(reach[:-1]) > 0)

    def count(member: np.ndarray) -> np.ndarray:
        x = np.zeros(len(c.buf) + 1, np.int64)
        np.cumsum(member[c.buf], out=x[1:])
        return x[c.offs[1:]] - x[c.offs[:-1]]

    letters = np.maximum(count(LETTER), 1)
    ups = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(UPPER[c.buf], out=ups[1:])
    caps = (ups[ends] - ups[starts] == ends - starts) & (ends - starts > 1)
    # tokens with a digit or symbol between letters: how many, and lexicon words among them undone
    ts, te = runs(c, DISGUISE)
    edge = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(LETTER[c.buf] ^ 1, out=edge[1:])
    odd = (te - ts > 2) & (edge[te] > edge[ts])
    ts, te = ts[odd], te[odd]
    inner = (LETTER[c.buf[ts]] == 1) & (edge[te - 1] > edge[ts + 1]) if len(ts) else np.zeros(0, bool)
    t_first = c.per_doc(ts)
    undone = span_hash(prefix_hash(UNDO[c.buf]), ts, te) if len(ts) else np.zeros(0, np.uint64)
    plain = (lex.lookup(lex.words, lex.word_odds, undone) > 0).astype(np.int64)
    size = np.maximum(np.diff(c.offs), 1)
    return np.column_stack([
        np.log1p(total(odds > 0)), total(odds > 0) / n, most(odds), total(odds) / n,
        np.log1p(total(stem > 0)), total(stem > 0) / n, most(stem), sums(plain, t_first) / n,
        total(near) / n, total(you) / n, count(UPPER) / letters, total(caps) / n, count(PUNCT) / size,
        count(EXCLAIM) / size, sums(inner.astype(np.int64), t_first) / n, np.log1p(np.diff(first))])


# ---------------------------------------------------------------------------
# Boosted trees and calibration
# ---------------------------------------------------------------------------


@dataclass
class Tree:
    feature: np.ndarray   # -1 on leaves
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(8):
            f = self.feature[at]
            go = f >= 0
            if not go.any():
                break
            right = x[np.arange(len(x)), np.maximum(f, 0)] > self.cut[at]
            at = np.where(go, self.left[at] + right, at)
        return self.value[at]


def grow(x: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, g: np.ndarray, h: np.ndarray,
         depth: int, min_h: float, ridge: float) -> Tree:
    """One regression tree on gradients and Hessians, split by histogram gain."""
    feature, cut, left, value = [-1], [0.0], [0], [0.0]
    todo = [(0, np.arange(len(g)), 0)]
    while todo:
        node, rows, d = todo.pop()
        gs, hs = g[rows].sum(), h[rows].sum()
        value[node] = -gs / (hs + ridge)
        if d == depth:
            continue
        best = (1e-6, -1, 0)
        for f in range(bins.shape[1]):
            k = len(cuts[f])
            if not k:
                continue
            gl = np.cumsum(np.bincount(bins[rows, f], g[rows], k + 1))[:-1]
            hl = np.cumsum(np.bincount(bins[rows, f], h[rows], k + 1))[:-1]
            gain = gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs ** 2 / (hs + ridge)
            gain[(hl < min_h) | (hs - hl < min_h)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
        if best[1] < 0:
            continue
        _, f, at = best
        feature[node], cut[node], left[node] = f, float(cuts[f][at]), len(feature)
        for _ in range(2):
            feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
        goes = x[rows, f] > cut[node]
        todo += [(left[node], rows[~goes], d + 1), (left[node] + 1, rows[goes], d + 1)]
    return Tree(np.array(feature), np.array(cut), np.array(left), np.array(value))


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for t in self.trees:
            z += self.rate * t.predict(x)
        return z


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15,
          n_bins: int = 64, min_h: float = 1.0, ridge: float = 1.0) -> Boosted:
    """Gradient boosting on weighted log loss."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(x.shape[1])])
    share = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
    m = Boosted(float(np.log(share / (1 - share))), rate, [])
    z = np.full(len(y), m.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        t = grow(x, cuts, bins, w * (p - y), w * np.maximum(p * (1 - p), 1e-6), depth, min_h, ridge)
        m.trees.append(t)
        z += rate * t.predict(x)
    return m


def isotonic(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: margins (ascending) and non-decreasing weighted means."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []  # sum of w*y, sum of w, sum of w*z
    for i in order:
        blocks.append([w[i] * y[i], w[i], w[i] * z[i]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    # one pseudo-row of each class keeps the ends off 0 and 1
    return b[:, 2] / b[:, 1], (b[:, 0] + 0.01) / (b[:, 1] + 0.02)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted | None
    knots: np.ndarray
    levels: np.ndarray
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        return np.interp(self.trees.margin(x), self.knots, self.levels)


# ---------------------------------------------------------------------------
# Fitting
# ---------------------------------------------------------------------------


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y, fold) to one row per distinct lexicon candidate of each text."""
    for b in batches:
        y, fold = (b.column(j).to_numpy(zero_copy_only=False) for j in (1, 2))
        for c in text_chunks(b.column(0)):
            s, starts, ends, h = _words(c)
            doc = doc_index(c.per_doc(starts))
            parts = [(doc, h, np.zeros(len(h), np.int32))]
            for k in STEMS:
                at, hs = _stem_hashes(s, starts, ends, k)
                parts.append((doc[at], hs, np.full(len(at), k, np.int32)))
            d, h, k = (np.concatenate([p[j] for p in parts]) for j in range(3))
            _, at = np.unique(mix64(h + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
            d, h, k = d[at], h[at], k[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(k), pa.array(y[c.lo + d].astype(np.int32)),
                 pa.array(fold[c.lo + d].astype(np.int32))], names=["h", "k", "y", "fold"])


def _lexicon(rows: list, pos: float, neg: float, fold: int | None, min_docs: int) -> Lexicon:
    """Entries held by ``min_docs`` toxic documents and far more often than by the others."""
    got: dict[bool, list] = {True: [], False: []}
    for r in rows:
        p, n = ((r["p0"] + r["p1"], r["n0"] + r["n1"]) if fold is None else (r[f"p{fold}"], r[f"n{fold}"]))
        if p >= min_docs:
            odds = float(np.log((p + 0.5) / (pos + 1)) - np.log((n + 0.5) / (neg + 1)))
            if odds > MIN_ODDS and p > 2 * n * (pos + 1) / (neg + 1):
                got[r["k"] == 0].append((np.uint64(r["h"] & ((1 << 64) - 1)), odds))
    out = []
    for whole in (True, False):
        got[whole].sort(key=lambda e: int(e[0]))
        out += [np.array([e[0] for e in got[whole]], np.uint64), np.array([e[1] for e in got[whole]])]
    return Lexicon(*out)


def telling(p: Column, n: Column, pos: float, neg: float, min_docs: int) -> Column:
    """The rule of ``_lexicon`` as a filter over entry counts."""
    odds = F.log((p + 0.5) / (pos + 1)) - F.log((n + 0.5) / (neg + 1))
    return (p >= min_docs) & (odds > MIN_ODDS - 1e-6) & (p > 2 * n * ((pos + 1) / (neg + 1)) - 1e-6)


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", per_class: int = 3000, min_docs: int = 3, seed: int = 5) -> ToxicityModel:
    """Fit on labelled rows that ``trainable`` (over ``doc_id``) selects."""
    known = (labels.filter(trainable & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    shares = known.groupBy("y").count().toArrow().to_pylist()
    of = {int(r["y"]): r["count"] for r in shares if r["y"] in (0, 1)}
    empty = Lexicon(*(np.zeros(0, t) for t in (np.uint64, float, np.uint64, float)))
    share = of.get(1, 0) / max(sum(of.values()), 1)
    ids = persisted(sample_ids(known.filter(F.col("y").isin(0, 1)), "id", "y", per_class, seed))
    # at most 2 * per_class ids, so safe to broadcast; equal texts are one training row
    sample = persisted(docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
                       .join(F.broadcast(ids), "id").withColumn("key", F.xxhash64("t"))
                       .dropDuplicates(["key"])
                       .select("t", "y", F.pmod(F.xxhash64("key"), F.lit(2)).cast("int").alias("fold"), "key"))
    got = {(r["y"], r["fold"]): r["count"] for r in sample.groupBy("y", "fold").count().toArrow().to_pylist()}
    pos, neg = ({f: float(got.get((y, f), 0)) for f in (0, 1)} for y in (1, 0))
    if not sum(pos.values()) or not sum(neg.values()):
        return ToxicityModel(empty, None, np.zeros(1), np.zeros(1), share)

    def n(y: int, f: int) -> Column:
        return F.sum(F.when((F.col("y") == y) & (F.col("fold") == f), 1).otherwise(0))

    half_docs = max(2, min_docs // 2)
    entries = (sample.select("t", "y", "fold").mapInArrow(_entries, "h long, k int, y int, fold int")
               .groupBy("h", "k").agg(n(1, 0).alias("p0"), n(1, 1).alias("p1"), n(0, 0).alias("n0"), n(0, 1).alias("n1"))
               .filter(telling(F.col("p0") + F.col("p1"), F.col("n0") + F.col("n1"), sum(pos.values()), sum(neg.values()), min_docs)
                       | telling(F.col("p0"), F.col("n0"), pos[0], neg[0], half_docs)
                       | telling(F.col("p1"), F.col("n1"), pos[1], neg[1], half_docs))
               .toArrow().to_pylist())  # what the bounded sample can tell
    whole = _lexicon(entries, sum(pos.values()), sum(neg.values()), None, min_docs)
    halves = [_lexicon(entries, pos[f], neg[f], f, half_docs) for f in (0, 1)]
    person = hash_words(SECOND_PERSON)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold = b.column(2).to_numpy(zero_copy_only=False)
            for c in text_chunks(b.column(0)):
                x = [features(c, lex, person) for lex in halves]
                f = fold[c.lo:c.hi]
                mine = np.where((f == 0)[:, None], x[1], x[0])  # the other half's lexicon
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(c.lo, c.n_docs), b.column(2).slice(c.lo, c.n_docs),
                     b.column(3).slice(c.lo, c.n_docs), pa.array(list(mine), pa.list_(pa.float64()))],
                    names=["y", "fold", "key", "x"])

    rows = sample.mapInArrow(go, "y int, fold int, key long, x array<double>").toArrow().to_pylist()
    rows.sort(key=lambda r: r["key"])  # whatever the partitioning
    x, y, fold = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float), np.array([r["fold"] for r in rows])
    # sampled rows weigh as their class does among all training rows
    w = np.where(y == 1, of[1] / y.sum(), of[0] / (1 - y).sum())
    w = w / w.mean()
    trees = boost(x, y, w)
    z = np.zeros(len(y))
    for f in (0, 1):
        if (fold == f).any() and 0 < y[fold != f].sum() < (fold != f).sum():
            z[fold == f] = boost(x[fold != f], y[fold != f], w[fold != f]).margin(x[fold == f])
        else:
            z[fold == f] = trees.margin(x[fold == f])
    knots, levels = isotonic(z, y, w)
    return ToxicityModel(whole, trees, knots, levels, share)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1; ``_score`` if ``keep`` has such a column) for each row of ``docs``,
    after doc_id or the columns ``keep``; only the text is read for it."""
    cols = list(dict.fromkeys([*(keep or [doc_id]), text]))
    src = docs.select(*cols)
    at, kept = cols.index(text), keep or [doc_id]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the lexicon of the bounded sample and 60 small trees
    person = hash_words(SECOND_PERSON)
    out_name = "score"
    while out_name in {c.lower() for c in cols}:
        out_name = "_" + out_name

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for c in text_chunks(b.column(at)):
                s = m.score(features(c, m.lexicon, person))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(j).slice(c.lo, c.n_docs) for j, n in enumerate(cols) if n in kept), pa.array(s)],
                    names=[*(n for n in cols if n in kept), out_name])

    schema = src.select(*(n for n in cols if n in kept)).schema.add(out_name, "double")
    return src.mapInArrow(go, schema)
