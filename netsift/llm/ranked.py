"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, score intervals.

*Index.* One Arrow pass over the texts, which are never shuffled, cuts each input partition
into segments of a bounded number of postings. A segment holds its documents (ordered by
id), their term counts and, for each term of the query set, the documents with the term
and how often they hold it. Segments are checkpointed in the shared folder; a frequent
term is spread over all segments instead of meeting in one task.

*Weights.* Documents with a term, all terms with repeats and the documents of each term
are summed from the segments (partial aggregations), so they cover every document.

*Search.* In each segment the lists are sorted by impact, and every query reads its lists
from the top down to a falling level of score (NRA: no random access). What was read is a
document's lower bound; the next unread impact of each list where the document was not
met yet adds up to its upper bound. While a document that no list has shown could still
come in, all documents are kept (growing); then only those whose upper bound may reach the
k-th lower bound (shrinking), until no kept document has an open interval: members,
ties and scores are then final. Each segment returns its best ``k`` documents of a query,
and the best of all segments are the result.

*Thresholds.* A hashed share of the segments (``pilot_every``) is searched first; the k-th
score found there is a lower bound for the whole table, so the other segments stop early
and return few rows, however many segments there are.

The query set is searched in blocks of about ``block_terms`` (item, term) rows, so what is
sent to the executors is bounded; the index is built once for all blocks. It keeps the
terms whose hash remainder occurs in the query set (a bit map of fixed size), hence every
term of it. Terms are compared by 64-bit hashes of their bytes.

Edge cases: a null or empty text has no terms and is in no result; a null document id
ranks after the others at equal scores; repeated rows are each a document; equal items
(id and text) are one query, and equal ids with different texts are queries of their own;
an item without known terms has no result; empty tables give an empty result; only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import persisted
from .textops import FOLD, byte_class, doc_index, prefix_hash, runs, span_hash, text_chunks

TERM = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
SEGMENT_POSTINGS = 1 << 20
BLOCK_TERMS = 1_000_000
PILOT_EVERY = 16
REMAINDERS = 1 << 22
LENGTH_SHARE = 75  # percent of a document's length in its normaliser


def _counted(c, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text, term, count) of its distinct wanted terms."""
    starts, ends = runs(c, TERM)
    terms = span_hash(prefix_hash(c.buf, FOLD), starts, ends).view(np.int64)
    first = c.per_doc(starts)
    doc = doc_index(first)
    if wanted is not None:
        at = np.flatnonzero(wanted[terms & (REMAINDERS - 1)])
        terms, doc = terms[at], doc[at]
    known, which = np.unique(terms, return_inverse=True)
    pair, count = np.unique(which * np.int64(c.n_docs) + doc, return_counts=True)
    return np.diff(first), pair % c.n_docs, known[pair // c.n_docs], count


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, text) to one row per distinct term of each item."""
    for b in batches:
        for c in text_chunks(b.column(1)):
            _, doc, term, count = _counted(c, None)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(c.lo, c.n_docs).take(pa.array(doc)), pa.array(term),
                                              pa.array(count.astype(np.int64))], names=["q", "term", "times"])


def _one(arr: pa.Array) -> pa.ListArray:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(arr)], pa.int32()), arr)


class _Segment:
    """Postings gathered from the chunks of a task until they are written as one row."""

    def __init__(self):
        self.ids, self.lengths, self.docs, self.terms, self.counts, self.n, self.size = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray) -> None:
        has = lengths > 0  # a text without a term is no document
        place = np.cumsum(has) - 1 + self.n
        self.ids.append(ids.filter(pa.array(has)))
        self.lengths.append(lengths[has])
        self.docs.append(place[doc])
        self.terms.append(term)
        self.counts.append(count)
        self.n += int(has.sum())
        self.size += len(doc) + int(has.sum())

    def row(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids, null_placement="at_end")
        place = np.empty(self.n, np.int64)
        place[order.to_numpy()] = np.arange(self.n)
        lengths = np.concatenate(self.lengths)
        doc, term, count = place[np.concatenate(self.docs)], np.concatenate(self.terms), np.concatenate(self.counts)
        by = np.lexsort((doc, term))
        term = term[by]
        new = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [_one(ids.take(order)), _one(pa.array(lengths[order.to_numpy()])), _one(pa.array(term[new])),
             _one(pa.array(np.append(new, len(term)).astype(np.int32))), _one(pa.array(doc[by].astype(np.int32))),
             _one(pa.array(count[by].astype(np.int64))), pa.array([self.n]), pa.array([int(lengths.sum())])],
            names=["ids", "lengths", "terms", "starts", "docs", "counts", "n_docs", "n_terms"])


def build_index(docs: DataFrame, wanted: np.ndarray, segment_postings: int = SEGMENT_POSTINGS) -> DataFrame:
    """Segments of (doc_id, text) rows; ``wanted``: bits of the term remainders to keep."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        seg = _Segment()
        for b in batches:
            for c in text_chunks(b.column(1)):
                seg.add(b.column(0).slice(c.lo, c.n_docs), *_counted(c, bits))
                if seg.size >= segment_postings:
                    yield seg.row()
                    seg = _Segment()
        if seg.n:
            yield seg.row()

    return docs.mapInArrow(go, f"ids array<{id_type}>, lengths array<long>, terms array<long>, starts array<int>, "
                               "docs array<int>, counts array<long>, n_docs long, n_terms long")


def document_counts(index: DataFrame) -> DataFrame:
    """(term, df): the documents that hold each stored term, over all segments."""
    n = F.zip_with(F.slice("starts", 2, F.size("terms")), F.slice("starts", 1, F.size("terms")), lambda b, a: b - a)
    held = index.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), n.alias("n"))).alias("l"))
    return held.groupBy(F.col("l.term").alias("term")).agg(F.sum("l.n").cast("long").alias("df"))


def normalisers(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length normaliser of each document, in hundredths of the mean length's."""
    if float(lengths.max(initial=0)) * LENGTH_SHARE * n_docs < 2 ** 62:
        return 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // n_terms
    return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // n_terms for x in lengths], np.int64)


def nra(lists: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of ``n_docs`` documents (index, score) with a score of at least ``floor``.

    ``lists`` holds (weight, documents, impacts), impacts descending. Equal scores rank by
    ascending index.
    """
    lower = np.zeros(n_docs, np.int64)
    at = np.zeros(len(lists), np.int64)
    bound = np.array([w * int(imp[0]) for w, _, imp in lists], np.int64)
    level = int(bound.max(initial=0))

    def read(t: int) -> slice:
        """The next postings of list ``t`` that score at least ``level``."""
        w, _, imp = lists[t]
        stop = int(np.searchsorted(-imp, -(-(-level // w)), "right"))
        got = slice(int(at[t]), max(stop, int(at[t])))
        at[t] = got.stop
        bound[t] = w * int(imp[got.stop]) if got.stop < len(imp) else 0
        return got

    # growing: a document that no list has shown may still come in
    while bound.sum() >= max(floor, 1):
        level = level // 2
        for t in np.flatnonzero(bound):
            w, docs, imp = lists[t]
            got = read(t)
            lower[docs[got]] += w * imp[got]
        if n_docs >= k:
            floor = max(floor, int(np.partition(lower, n_docs - k)[n_docs - k]))
    floor = max(floor, 1)
    cand = np.flatnonzero(lower + bound.sum() >= floor)
    cand = cand[lower[cand] > 0]

    # shrinking: intervals of the documents that may reach the k-th lower bound
    place = np.full(n_docs, -1, np.int64)
    place[cand] = np.arange(len(cand))
    unread = np.zeros((len(cand), len(lists)), bool)
    unread[:, bound > 0] = True
    for t in np.flatnonzero(bound):
        j = place[lists[t][1][:at[t]]]
        unread[j[j >= 0], t] = False
    while True:
        upper = lower[cand] + unread @ bound
        order = np.lexsort((cand, -lower[cand]))
        stay = upper >= floor
        if len(cand) > k:
            last = order[k - 1]
            low = lower[cand[last]]
            stay &= (upper > low) | ((upper == low) & (cand <= cand[last]))
        if not stay.all():
            place[cand[~stay]] = -1
            cand, unread, upper = cand[stay], unread[stay], upper[stay]
            place[cand] = np.arange(len(cand))
        open_lists = np.flatnonzero(unread.any(axis=0) & (bound > 0))
        if not len(open_lists):
            break
        level = level // 2
        for t in open_lists:
            w, docs, imp = lists[t]
            got = read(t)
            j = place[docs[got]]
            met = j >= 0
            lower[docs[got][met]] += w * imp[got][met]
            unread[j[met], t] = False
    order = np.lexsort((cand, -lower[cand]))[:k]
    return cand[order], lower[cand[order]]


def _search(shared, k: int, n_docs: int, n_terms: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floors = shared.value
        for b in batches:
            for r in range(b.num_rows):
                ids = b.column(0)[r].values
                lengths, terms, starts, docs, counts = (b.column(j)[r].values.to_numpy(zero_copy_only=False) for j in range(1, 6))
                m = normalisers(lengths, n_docs, n_terms)
                impact = 1_000_000_000 * counts // (1000 * counts + 8 * m[docs])
                # impact-sorted lists, ties by document
                by = np.lexsort((docs, -impact, np.repeat(np.arange(len(terms)), np.diff(starts))))
                docs, impact = docs[by], impact[by]
                out_q, out_doc, out_score = [], [], []
                for q, (want, weight) in block.items():
                    if not len(terms):
                        break
                    i = np.minimum(np.searchsorted(terms, want), len(terms) - 1)
                    lists = [(int(w), docs[starts[t]:starts[t + 1]], impact[starts[t]:starts[t + 1]])
                             for t, w in zip(i[terms[i] == want], weight[terms[i] == want])]
                    best, score = nra(lists, len(ids), k, floors.get(q, 1))
                    out_q.append(np.full(len(best), q, np.int64))
                    out_doc.append(best)
                    out_score.append(score)
                if out_q:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out_q)), ids.take(pa.array(np.concatenate(out_doc))),
                         pa.array(np.concatenate(out_score))], names=["q", "doc_id", "score"])
    return go


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, with ``rank``."""
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, segment_postings: int = SEGMENT_POSTINGS,
           block_terms: int = BLOCK_TERMS, pilot_every: int = PILOT_EVERY) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, scores above 0.

    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document scores the sum of weight
    times (10^9 tf) div (1000 tf + 8 m) over the item's terms with repeats, m being
    25 + (75 n N) div L.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    queries = persisted(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
                        .withColumn("q", F.monotonically_increasing_id()))
    asked = persisted(queries.select("q", "text").mapInArrow(_item_terms, "q long, term long, times long"))
    wanted = np.zeros(REMAINDERS, bool)  # at most REMAINDERS values reach the driver
    wanted[asked.select(F.pmod("term", F.lit(REMAINDERS)).alias("r")).distinct().toArrow()["r"].to_numpy()] = True
    index = persisted(build_index(rows, wanted, segment_postings))
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(total["n"]), max(int(total["l"]), 1)
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = persisted(asked.join(document_counts(index), "term").select("q", "term", (F.col("times") * weight).alias("w"))
                         .filter(F.col("w") > 0))  # a weight of 0 adds nothing to any score
    n_blocks = max(1, -(-weighted.count() // block_terms))
    pilot = F.pmod(F.xxhash64("n_terms", "n_docs"), F.lit(pilot_every)) == 0
    schema = f"q long, doc_id {id_type}, score long"
    parts = []
    for i in range(n_blocks):
        # one block of the query set: about block_terms rows, whatever the number of items
        got = weighted.filter(F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == i).orderBy("q", "term").toArrow()
        q, term, w = (got[c].to_numpy() for c in ("q", "term", "w"))
        cut = np.flatnonzero(np.diff(q, prepend=q[:1] - 1 if len(q) else 0))
        block = {int(q[a]): (term[a:e], w[a:e]) for a, e in zip(cut, np.append(cut[1:], len(q)))}
        first = persisted(_best(index.filter(pilot).mapInArrow(
            _search(spark.sparkContext.broadcast((block, {})), k, n_docs, n_terms), schema), k))
        # the k-th score of the pilot segments: one number per item of the block
        floors = {r["q"]: r["score"] for r in first.filter(F.col("rank") == k).select("q", "score").toArrow().to_pylist()}
        rest = index.filter(~pilot).mapInArrow(
            _search(spark.sparkContext.broadcast((block, floors)), k, n_docs, n_terms), schema)
        parts += [first.drop("rank"), rest]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return (_best(found, k).join(queries.select("q", "item_id"), "q")
            .select("item_id", "rank", "doc_id", "score"))
