"""Benchmark decontamination with a distributed positional inverted index.

*Index.* The training side is cut into segments: the documents of one Arrow batch piece,
a bounded number of bytes. A segment stores, for each test term that occurs in it, the
posting list of its word positions, with the word count of each of its documents. Only
terms of the test vocabulary are ever looked up, so others are not stored. Segments are
written to the shared folder (checkpoint); texts are read once, never shuffled,
and a frequent term is spread over all segments instead of meeting in one task.

*Rarity.* Corpus-wide term counts (one partial aggregation over the posting lists) order
the terms of every test phrase from the rarest.

*Search.* In each segment a phrase starts from the posting list of its rarest term,
shifted by the term's offset, and intersects the shifted lists of the next rarer terms
until it is empty or all terms agree: exact phrase matches. With ``slop`` > 0 there are
proximity matches too: starts from which every term has a posting within ``slop`` words of
its place, so that words may be inserted, left out or swapped. The same intersection finds
them, from all starts within ``slop`` of those that the rarest term gives.

The test side is a stated query set. The index is built once for all of it: it keeps the
terms whose hash remainder occurs in the set (a bit map of fixed size), hence every term of
it. It is searched in blocks of about ``block_phrases`` distinct phrases, so what is sent to
the executors is bounded whatever the size of the benchmark; matches of all blocks are
merged by document.

Terms and phrases are compared by 64-bit hashes of their bytes.

Edge cases: a null or empty text has no words and no windows; an item shorter than the
window is one phrase; phrases shared by items count for each; repeated rows are each
searched; an empty benchmark matches nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .textops import FOLD, byte_class, prefix_hash, runs, span_hash, text_chunks

WORD = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
WINDOW = 13
SLOP = 2
SEGMENT_BYTES = 2 << 20
BLOCK_PHRASES = 100_000
REMAINDERS = 1 << 22

_ITEM = "item string, terms array<long>"


def _phrases(window: int):
    """mapInArrow body: (item, text) to one row per distinct window of the item."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in text_chunks(b.column(1)):
                starts, ends = runs(c, WORD)
                words = span_hash(prefix_hash(c.buf, FOLD), starts, ends).view(np.int64)
                first = c.per_doc(starts)
                items, out = b.column(0).slice(c.lo, c.n_docs).to_pylist(), []
                for r in range(c.n_docs):
                    w = words[first[r]:first[r + 1]]
                    if len(w):
                        for s in range(max(1, len(w) - window + 1)):
                            out.append((items[r], w[s:s + window].tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()),
                                                  pa.array([x[1] for x in out], pa.list_(pa.int64()))],
                                                 names=["item", "terms"])
    return go


def phrases(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, terms): the distinct windows of every item, as word hashes."""
    src = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(_phrases(window), _ITEM).distinct()


def _segment_schema(id_type: str) -> str:
    return (f"ids array<{id_type}>, text_hash array<long>, n_words array<int>, terms array<long>, "
            "starts array<int>, positions array<int>")


def _one(values, kind=None) -> pa.ListArray:
    """A list column of one row."""
    arr = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(arr)], pa.int32()), arr)


def build_index(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Positional segments of (doc_id, text) rows; ``wanted``: bits of the term remainders to keep."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            for c in text_chunks(b.column(1), SEGMENT_BYTES):
                starts, ends = runs(c, WORD)
                s = prefix_hash(c.buf, FOLD)
                words = span_hash(s, starts, ends).view(np.int64)
                first = c.per_doc(starts)
                pos = np.flatnonzero(bits[words & (REMAINDERS - 1)])
                term = words[pos]
                order = np.argsort(term, kind="stable")
                term, pos = term[order], pos[order].astype(np.int32)
                new = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                th = span_hash(s, c.offs[:-1], c.offs[1:]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_one(b.column(0).slice(c.lo, c.n_docs)), _one(th), _one(np.diff(first).astype(np.int32)),
                     _one(term[new]), _one(np.append(new, len(pos)).astype(np.int32)), _one(pos)],
                    names=["ids", "text_hash", "n_words", "terms", "starts", "positions"])

    return docs.mapInArrow(go, _segment_schema(docs.schema["doc_id"].dataType.simpleString()))


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): occurrences of each stored term over all segments."""
    lists = index.select(F.explode(F.arrays_zip(
        F.col("terms").alias("term"),
        F.zip_with(F.slice("starts", 2, F.size("terms")), F.slice("starts", 1, F.size("terms")),
                   lambda b, a: b - a).alias("n"))).alias("l"))
    return lists.groupBy(F.col("l.term").alias("term")).agg(F.sum("l.n").alias("n"))


class Block:
    """Distinct phrases with their terms ordered from the rarest, by their rarest term."""

    def __init__(self, rows: list[tuple[list[int], list[str]]], count: dict[int, int]):
        self.items = [r[1] for r in rows]
        self.lengths = np.array([len(r[0]) for r in rows], np.int64)
        self.longest = int(self.lengths.max()) if rows else 0
        self.orders = []
        self.by_rarest: dict[int, list[int]] = {}
        for p, (terms, _) in enumerate(rows):
            order = sorted(range(len(terms)), key=lambda j: (count.get(terms[j], 0), j))
            self.orders.append([(terms[j], j) for j in order])
            self.by_rarest.setdefault(terms[order[0]], []).append(p)

    def search(self, lists: dict[int, np.ndarray], slop: int) -> Iterator[tuple[int, np.ndarray]]:
        """(phrase, start positions) of every phrase that occurs, each term within ``slop``
        words of its place."""
        for term in self.by_rarest.keys() & lists.keys():
            for p in self.by_rarest[term]:
                cand = lists[term] - self.orders[p][0][1]
                if slop:
                    cand = np.unique(cand[:, None] + np.arange(-slop, slop + 1))
                for t, j in self.orders[p][1:]:
                    if t not in lists:
                        cand = cand[:0]
                        break
                    lst = lists[t] - j
                    k = np.searchsorted(lst, cand - slop)
                    near = lst[np.minimum(k, len(lst) - 1)]
                    cand = cand[(k < len(lst)) & (near <= cand + slop)]
                    if not len(cand):
                        break
                if len(cand):
                    yield p, cand


def _search_segments(shared, slop: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for b in batches:
            for r in range(b.num_rows):
                ids = b.column(0)[r].values
                th, nw, terms, starts, pos = (b.column(j)[r].values.to_numpy(zero_copy_only=False) for j in range(1, 6))
                n = len(ids)
                # positions with a gap between documents that no match can bridge
                gap = block.longest + 2 * slop + 1
                first = np.concatenate([[0], np.cumsum(nw, dtype=np.int64)])
                doc = np.searchsorted(first, pos, "right") - 1
                apart = pos + doc * gap
                begin = first[:-1] + np.arange(n) * gap
                lists = {int(t): apart[starts[i]:starts[i + 1]] for i, t in enumerate(terms)}
                items: list[set] = [set() for _ in range(n)]
                near: list[set] = [set() for _ in range(n)]
                step = np.zeros(int(first[-1]) + n * gap + 1, np.int64)
                for p, cand in block.search(lists, 0):
                    for x in np.unique(np.searchsorted(begin, cand, "right") - 1):
                        items[x].update(block.items[p])
                    np.add.at(step, cand, 1)
                    np.subtract.at(step, cand + block.lengths[p], 1)
                if slop:
                    for p, cand in block.search(lists, slop):
                        # the start of a loose match may lie before its document
                        for x in np.unique(np.searchsorted(begin, cand + slop, "right") - 1):
                            near[x].update(block.items[p])
                covered = np.cumsum(step) > 0
                edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
                at = np.searchsorted(begin, edge[::2], "right") - 1
                spans: list[list[int]] = [[] for _ in range(n)]
                n_hit = np.zeros(n, np.int64)
                for x, s, e in zip(at, edge[::2], edge[1::2]):
                    spans[x] += [int(s - begin[x]), int(e - begin[x])]
                    n_hit[x] += e - s
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(th), pa.array(nw.astype(np.int64)), pa.array(n_hit),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                     pa.array([sorted(x) for x in near], pa.list_(pa.string())),
                     pa.array(spans, pa.list_(pa.int32()))],
                    names=["doc_id", "text_hash", "n_words", "n_hit", "items", "near_items", "spans"])
    return go


def find_phrases(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int = SLOP,
                 block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside exact matches), items
    (sorted ids with an exact match), near_items (sorted ids with a proximity match, exact ones
    included; empty at ``slop`` 0) and spans of hit words (word positions: start, end, start, end, ...)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ph = persisted(phrases(items, item_id, item_text, window).groupBy("terms")
                   .agg(F.sort_array(F.collect_set("item")).alias("items")))
    n_blocks = max(1, -(-ph.count() // block_phrases))
    wanted = np.zeros(REMAINDERS, bool)  # at most REMAINDERS values reach the driver
    terms = ph.select(F.explode("terms").alias("term"))
    wanted[terms.select(F.pmod("term", F.lit(REMAINDERS)).alias("r")).distinct().toArrow()["r"].to_numpy()] = True
    index = persisted(build_index(rows, wanted))
    counts = persisted(term_counts(index))
    found = None
    for k in range(n_blocks):
        # one block of the query set: about block_phrases phrases, whatever the benchmark's size
        mine = ph.filter(F.pmod(F.xxhash64("terms"), F.lit(n_blocks)) == k)
        block = mine.toArrow()
        pairs = sorted(zip(block["terms"].to_pylist(), block["items"].to_pylist()))
        held = mine.select(F.explode("terms").alias("term")).distinct().join(counts, "term").toArrow()  # the block's terms
        count = dict(zip(held["term"].to_pylist(), held["n"].to_pylist()))
        shared = spark.sparkContext.broadcast(Block(pairs, count))
        part = index.mapInArrow(_search_segments(shared, slop),
                                f"doc_id {id_type}, text_hash long, n_words long, n_hit long, items array<string>, "
                                "near_items array<string>, spans array<int>")
        found = part if found is None else found.unionByName(part)
    if n_blocks > 1:
        found = _merge_blocks(found, n_blocks)
    return found.select("doc_id", "n_words", "n_hit", "items", "near_items", "spans")


def _merge_blocks(found: DataFrame, n_blocks: int) -> DataFrame:
    """One row per document from its rows of all blocks (rows equal in id and text are alike)."""
    def pairs(spans):  # start, end, start, end, ... as (a, b)
        at = F.filter(F.transform(spans, lambda x, i: F.struct(x.alias("a"), F.get(spans, i + 1).alias("b"), i.alias("i"))),
                      lambda s: s["i"] % 2 == 0)
        return F.transform(at, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))

    def grown(out, s):  # the next span begins inside the last one, or behind it
        last = F.element_at(out, -1)
        return (F.when((F.size(out) > 0) & (s["a"] <= last),
                       F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(last, s["b"]))))
                .otherwise(F.concat(out, F.array(s["a"], s["b"]))))

    def union_spans(all_spans):
        return F.aggregate(F.array_sort(F.flatten(F.transform(all_spans, pairs))), F.array().cast("array<int>"), grown)

    def united(c: str):
        return F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)

    merged = (found.groupBy("doc_id", "text_hash", "n_words")
              .agg(united("items"), united("near_items"), F.collect_set("spans").alias("all"),
                   F.count(F.lit(1)).alias("n"))
              .withColumn("spans", union_spans(F.col("all")))
              .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") / n_blocks).cast("int")))))
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    return merged.withColumn("n_hit", F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x))
