"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's features are its byte n-grams (3 and 4 bytes, A-Z folded, white space as one
class) hashed into ``BUCKETS`` buckets. The model averages one embedding per n-gram and
applies a linear softmax; both are trained by mini-batch stochastic gradient descent in
NumPy on the driver, on a bounded sample: at most ``sample_per_lang`` labelled documents
of each language, chosen by a hash of the id (a documented bound, whatever the input).
Executors turn the sampled texts into n-gram counts, so the driver receives
sparse counts, never texts.

A softmax of a mean is linear in the n-gram counts, so scoring reads one row of
``embeddings @ weights`` per n-gram of the whole text. Probabilities are calibrated by a
temperature fitted on a fifth of the sampled documents, chosen by a hash of the text and not
trained on, and ``rejected`` marks scores below
the lowest confidence at which that part is right at the target precision.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; an empty
training set makes every document ``und``; null languages are never learned; repeated
rows are each scored; of several texts of one sampled id the least is learned; an empty table
gives an empty result; column names other than the given ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .textops import CHUNK_BYTES, FOLD, Chunk, byte_class, mix64, text_chunks

BUCKETS = 1 << 13
SIZES = (3, 4)
UNDETERMINED = "und"

_SPACE_FOLD = FOLD.copy()
_SPACE_FOLD[[9, 10, 11, 12, 13]] = 32
_ASCII_LETTER = byte_class([(65, 90), (97, 122)])
_HIGH = byte_class([(0x80, 0xFF)])


def ngram_ids(buf: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the ``size``-byte gram that starts at each byte; its last bytes start none."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    b = _SPACE_FOLD[buf].astype(np.uint32)
    code = np.full(n, size, np.uint32)
    for j in range(size):
        code = code * np.uint32(0x01000193) + b[j:n + j] * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA6B)
    code ^= code >> np.uint32(13)
    return (code & np.uint32(BUCKETS - 1)).astype(np.int64)


def _inside(c: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: first gram start and one past the last gram start."""
    last = np.maximum(c.offs[1:] - size + 1, c.offs[:-1])
    return c.offs[:-1], last


def text_counts(raw: bytes) -> np.ndarray:
    """n-gram counts of one text, as a vector of BUCKETS."""
    buf = np.frombuffer(raw, np.uint8)
    out = np.zeros(BUCKETS, np.float32)
    for size in SIZES:
        out += np.bincount(ngram_ids(buf, size), minlength=BUCKETS)
    return out


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray        # BUCKETS x languages: embeddings @ weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = (total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def score_chunk(self, c: Chunk) -> np.ndarray:
        """Calibrated probabilities of every language, one row per text."""
        k = len(self.langs)
        total, n = np.zeros((c.n_docs, k)), np.zeros(c.n_docs, np.int64)
        for size in SIZES:
            ids = ngram_ids(c.buf, size)
            lo, hi = _inside(c, size)
            hi = np.minimum(hi, len(ids))
            lo = np.minimum(lo, hi)
            for j in range(k):
                s = np.zeros(len(ids) + 1)
                np.cumsum(self.table[:, j][ids], out=s[1:])
                total[:, j] += s[hi] - s[lo]
            n += hi - lo
        return self.probabilities(total, n)


@dataclass
class Counts:
    """n-gram counts of pieces of text, as compressed rows: buckets and counts of each."""
    cut: np.ndarray
    ids: np.ndarray
    ns: np.ndarray

    def means(self, rows: np.ndarray) -> np.ndarray:
        """The given rows as dense shares of BUCKETS."""
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for at, r in enumerate(rows):
            part = slice(self.cut[r], self.cut[r + 1])
            out[at, self.ids[part]] = self.ns[part] / max(self.ns[part].sum(), 1)
        return out


def train(x: Counts, y: np.ndarray, cal: np.ndarray, langs: list[str], dim: int = 16, epochs: int = 30,
          rate: float = 0.5, batch: int = 64, seed: int = 7, target_precision: float = 0.99) -> LanguageModel:
    """SGD on mean embeddings + softmax; the rows marked ``cal`` calibrate and are not trained on."""
    rng = np.random.default_rng(seed)
    k = len(langs)
    rows, yt = np.flatnonzero(~cal), y[~cal]
    e = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    w = np.zeros((dim, k), np.float32)
    bias = np.zeros(k, np.float32)
    w += rng.normal(0, 0.1, w.shape)
    scale = np.float32(20.0)  # a mean over many grams is small: the softmax sees it enlarged
    for epoch in range(epochs):
        step = np.float32(rate / (1 + 0.1 * epoch))
        order = rng.permutation(len(yt))
        for at in range(0, len(order), batch):
            i = order[at:at + batch]
            xb = x.means(rows[i])
            used = np.flatnonzero(xb.any(axis=0))  # buckets of the batch: the others do not change
            xb = xb[:, used]
            h = scale * (xb @ e[used])
            z = h @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(i)), yt[i]] -= 1
            p /= len(i)
            gh = p @ w.T
            w -= step * (h.T @ p)
            bias -= step * p.sum(axis=0)
            e[used] -= step * scale * (xb.T @ gh)
    m = LanguageModel(langs, (scale * (e @ w)).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    if cal.any():
        held = np.flatnonzero(cal)
        mean = np.concatenate([x.means(held[a:a + batch]) @ m.table for a in range(0, len(held), batch)])
        z, yc = mean + m.bias, y[cal]

        def loss(t: float) -> float:
            v = z / t
            v = v - v.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(v).sum(axis=1)) - v[np.arange(len(yc)), yc]))

        m.temperature = min((0.25 * 1.15 ** j for j in range(31)), key=loss)
        p = m.probabilities(mean, np.ones(len(yc), np.int64))
        conf, right = p.max(axis=1), p.argmax(axis=1) == yc
        order = np.argsort(-conf, kind="stable")
        good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= target_precision
        m.reject_below = float(conf[order[np.flatnonzero(good).max()]]) if good.any() else 1.0
    return m


def sample_ids(labelled: DataFrame, doc_id: str, label: str, per_label: int, seed: int) -> DataFrame:
    """At most ``per_label`` ids of each label: the least hash in each of ``per_label``
    hash buckets, a partial aggregation without a sort or a group in one task."""
    h = F.xxhash64(F.col(doc_id), F.lit(seed))
    return (labelled.select(F.col(doc_id).alias("id"), F.col(label).alias("y"),
                            F.pmod(h, F.lit(per_label)).alias("b"), F.xxhash64(h, F.lit(seed + 1)).alias("o"))
            .groupBy("y", "b").agg(F.min_by("id", "o").alias("id")).select("id", "y"))


def _segments(raw: bytes) -> list[bytes]:
    """The text and two short pieces of it, so that short texts are learned too."""
    n = len(raw)
    h = int(mix64(np.array([n + (raw[n // 2] if n else 0)], np.uint64))[0])
    out = [raw]
    for size in (40, 160):
        if n > 2 * size:
            at = h % (n - size)
            out.append(raw[at:at + size])
            h >>= 16
    return out


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, ns, ys, keys = [], [], [], []
        for t, y, key in zip(*(b.column(j).to_pylist() for j in range(3))):
            for seg in _segments((t or "").encode()):
                v = text_counts(seg)
                at = np.flatnonzero(v)
                if len(at):
                    ids.append(at.astype(np.int32))
                    ns.append(v[at])
                    ys.append(y)
                    keys.append(key)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ys, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(ns, pa.list_(pa.float32())),
             pa.array(keys, pa.int64())], names=["y", "ids", "ns", "key"])


def fit(docs: DataFrame, trainable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_per_lang: int = 320, seed: int = 11) -> LanguageModel | None:
    """Train on the rows that ``trainable`` selects (never on null languages or texts)."""
    rows = docs.filter(trainable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    ids = persisted(sample_ids(rows, doc_id, lang, sample_per_lang, seed))
    # bounded by sample_per_lang rows for each language, so safe to broadcast
    picked = (rows.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("y"))
              .join(F.broadcast(ids.select("id").distinct()), "id").groupBy("id").agg(F.min(F.struct("t", "y")).alias("r")))
    got = (picked.select("r.t", "r.y", F.xxhash64("r.t").alias("key"))
           .mapInArrow(_sparse, "y string, ids array<int>, ns array<float>, key long").toArrow())
    if not len(got):
        return None
    got = got.combine_chunks()
    names = got["y"].to_numpy(zero_copy_only=False)
    langs = sorted(set(names))
    ids, ns = (got[c].combine_chunks() for c in ("ids", "ns"))
    cut = np.asarray(ids.offsets)
    ids, ns = np.asarray(ids.values), np.asarray(ns.values)
    key = [(int(ids[a:b].sum()), int(b - a), float(ns[a:b].sum()), names[r], r) for r, (a, b) in enumerate(zip(cut, cut[1:]))]
    order = [k[-1] for k in sorted(key)]  # the same whatever the partitioning
    x = Counts(np.concatenate([[0], np.cumsum([cut[r + 1] - cut[r] for r in order])]),
               np.concatenate([ids[cut[r]:cut[r + 1]] for r in order]), np.concatenate([ns[cut[r]:cut[r + 1]] for r in order]))
    y = np.array([langs.index(names[r]) for r in order])
    # every piece of a document lies on one side, and so do copies of it
    cal = mix64(got["key"].to_numpy()[order].view(np.uint64)) % np.uint64(5) == 0
    if cal.all() or len(y) < 10:
        cal = np.zeros(len(y), bool)
    return train(x, y, cal, langs)


def has_letter(c: Chunk, texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter; only texts without ASCII letters are looked at in full."""
    def counts(t: np.ndarray) -> np.ndarray:
        s = np.zeros(len(c.buf) + 1, np.int64)
        np.cumsum(t[c.buf], out=s[1:])
        return s[c.offs[1:]] - s[c.offs[:-1]]
    out = counts(_ASCII_LETTER) > 0
    for r in np.flatnonzero(~out & (counts(_HIGH) > 0)):
        out[r] = any(ch.isalpha() for ch in texts[c.lo + int(r)].as_py())
    return out


def identify(docs: DataFrame, model: LanguageModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of ``docs``; only the text is read."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for c in text_chunks(b.column(1), CHUNK_BYTES):
                known = has_letter(c, b.column(1))
                if m is None:
                    known[:] = False
                best, score = np.zeros(c.n_docs, np.int64), np.zeros(c.n_docs)
                if known.any():
                    p = m.score_chunk(c)
                    best, score = p.argmax(axis=1), np.where(known, p.max(axis=1), 0.0)
                names = np.array((m.langs if m else []) + [UNDETERMINED], object)
                pred = names[np.where(known, best, len(names) - 1)]
                low = ~known | (score < (m.reject_below if m else 1.0))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.lo, c.n_docs), pa.array(pred, pa.string()), pa.array(score), pa.array(low)],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return src.mapInArrow(go, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")
