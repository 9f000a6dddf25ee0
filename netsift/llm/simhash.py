"""SimHash near-duplicates by bit-sliced comparison.

*Fingerprints.* One Arrow pass hashes the shingles of each whole text (XXH64) and takes
the majority of every bit. Only (id, fingerprint) leave the pass.

*Candidates.* Equal fingerprints are one node, so copies never meet as rows. The 64 bits
are cut into ``radius + 2`` bands; two fingerprints at most ``radius`` bits apart agree on
two bands at least, so each pair of bands is a key and every near pair shares one
(``radius`` + 2 choose 2 keys a node, about 21 bits each at radius 4). Groups of one
node are dropped after a count. A group of more than ``block`` nodes is cut into blocks
by a hash, and every pair of blocks is a task of its own: bounded memory, no cap.

*Comparison.* Within a group the fingerprints are stored vertically, one plane of 64-lane
words per bit. A fingerprint is compared with a word of 64 others at once: each plane's
differing lanes are added to bitwise counters by carry-save additions, and words all of
whose lanes exceed the radius are abandoned after every few planes. A group's links are
reduced to a spanning forest before they leave the task (never all pairs), and connected
components of the forest are those of all links.

Edge cases: null and empty texts have fingerprint zero and are linked like any other;
repeated rows share a node and each are returned; a null id never becomes a component's
name unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .components import connected_components
from .textops import FOLD, byte_class, runs, text_chunks

WORD = 1 - byte_class([(0x20, 0x20), (0x09, 0x0D)])
SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCK = 2048
SEED = 42


def _majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row, the bits set in more than half of its hashes."""
    out = np.zeros(len(first) - 1, np.uint64)
    n = np.diff(first)
    full = np.flatnonzero(n > 0)
    if not len(full):
        return out
    step = 1 << 17
    counts = np.zeros((len(full), 64), np.int64)
    row = np.repeat(np.arange(len(full)), n[full])
    for at in range(0, len(h), step):  # bits of a bounded number of hashes at a time
        bits = np.unpackbits(h[at:at + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r = row[at:at + step]
        begin = np.flatnonzero(np.diff(r, prepend=-1))
        counts[r[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    major = 2 * counts > n[full][:, None]
    out[full] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``; fp is the fingerprint as a signed long."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    digest = xxhash.xxh64_intdigest

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in text_chunks(b.column(1)):
                starts, ends = runs(c, WORD)
                first = c.per_doc(starts)
                # the same words with single spaces between them: a shingle is one slice
                size = ends - starts
                to = np.cumsum(size + 1) - (size + 1)
                n_bytes = int(size.sum())
                flat = np.full(int(to[-1] + size[-1]) if len(size) else 0, 32, np.uint8)
                inside = np.repeat(to - (np.cumsum(size) - size), size) + np.arange(n_bytes)
                flat[inside] = FOLD[c.buf[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(n_bytes)]]
                stop = to + size
                n = np.diff(first)
                k = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
                sh_first = np.concatenate([[0], np.cumsum(k)])
                at = np.repeat(first[:-1] - sh_first[:-1], k) + np.arange(int(sh_first[-1]))
                last = np.minimum(at + words, np.repeat(first[1:], k)) - 1
                view = memoryview(flat)
                h = np.fromiter((digest(view[s:e], SEED) for s, e in zip(to[at].tolist(), stop[last].tolist())),
                                np.uint64, len(at))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.lo, c.n_docs), pa.array(_majority(h, sh_first).view(np.int64))],
                    names=["doc_id", "fp"])

    return src.mapInArrow(go, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


def bands(radius: int) -> list[int]:
    """Masks of pairs of bands: fingerprints within ``radius`` bits agree under one at least."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    one = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(one, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(radius: int) -> Column:
    """(pair of bands, bits under its mask) of a fingerprint, for every pair."""
    return F.array(*(F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for i, m in enumerate(bands(radius))))


# ---------------------------------------------------------------------------
# Bit-sliced comparison
# ---------------------------------------------------------------------------

ALL = np.uint64((1 << 64) - 1)


def planes(fp: np.ndarray) -> np.ndarray:
    """Vertical storage: plane p, word w, lane l holds bit p of fingerprint 64 * w + l."""
    n = -(-len(fp) // 64)
    padded = np.zeros(n * 64, np.uint64)
    padded[:len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def compare(fp: np.ndarray, store: np.ndarray, q: np.ndarray, w: np.ndarray, lanes: np.ndarray, radius: int,
            every: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within ``radius`` bits: for each (query q, word w) with the wanted ``lanes``,
    the kept queries and words come back as flat (query, lane index) pairs."""
    digits = max(1, int(radius).bit_length())
    counter = [np.zeros(len(q), np.uint64) for _ in range(digits)]
    over = np.zeros(len(q), np.uint64)
    for p in range(64):
        want = (np.uint64(0) - ((fp[q] >> np.uint64(p)) & np.uint64(1)))  # all ones where the query's bit is set
        carry = store[p, w] ^ want
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if p % every == every - 1:
            alive = (lanes & ~_exceeds(counter, over, radius)) != 0
            if not alive.all():  # abandon words all of whose lanes exceed the radius
                q, w, lanes, over = q[alive], w[alive], lanes[alive], over[alive]
                counter = [x[alive] for x in counter]
                if not len(q):
                    break
    near = lanes & ~_exceeds(counter, over, radius)
    bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 64)
    i, lane = np.nonzero(bits)
    return q[i], w[i] * 64 + lane


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose bitwise counter is above the radius (or has run over)."""
    above, equal = np.zeros_like(over), np.full_like(over, ALL)
    for d in range(len(counter) - 1, -1, -1):
        if radius >> d & 1:
            equal &= counter[d]
        else:
            above |= equal & counter[d]
            equal &= ~counter[d]
    return above | over


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> None:
    """Join the labels of linked items in place: every item ends at its group's least index."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def group_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int,
                most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the near pairs within each group; ``group`` is ascending.

    ``side``: 0 compares all of a group; rows of sides 1 and 2 are compared across only.
    """
    n = len(fp)
    store = planes(fp)
    begin = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if n else 0))
    end = np.append(begin[1:], n)
    of = np.repeat(np.arange(len(begin)), end - begin)
    lo, hi = begin[of], end[of]
    # each query against later rows of its group, or against side 2 for a query of side 1
    start = np.arange(n) + 1
    two = np.flatnonzero(side == 2)
    if len(two):
        first_two = np.full(len(begin), n)
        np.minimum.at(first_two, of[two], two)
        start = np.where(side == 1, np.minimum(first_two[of], hi), start)
        hi = np.where(side == 2, 0, hi)
    ask = np.flatnonzero(start < hi)
    label = np.arange(n)
    n_words = (hi[ask] - 1) // 64 - start[ask] // 64 + 1
    done = 0
    total = np.cumsum(n_words)
    while done < len(ask):
        # a bounded number of (query, word) comparisons at a time
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + most, "right")))
        k = ask[done:upto]
        m = n_words[done:upto]
        q = np.repeat(k, m)
        w = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[k] // 64, m)
        from_lane = np.maximum(start[q] - w * 64, 0).astype(np.uint64)
        to_lane = np.minimum(hi[q] - w * 64, 64).astype(np.uint64)
        lanes = (ALL << from_lane) & (ALL >> (np.uint64(64) - to_lane))
        a, b = compare(fp, store, q, w, lanes, radius)
        _forest(n, a, b, label)
        done = upto
    child = np.flatnonzero(label != np.arange(n))
    return label[child], child


def _links(radius: int):
    """mapInArrow body over rows (g, side, fp) in order of g: spanning links (a, b)."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []

        def emit(g: np.ndarray, side: np.ndarray, fp: np.ndarray):
            _, first = np.unique(g, return_index=True)
            group = np.zeros(len(g), np.int64)
            group[first] = 1
            a, b = group_links(fp, np.cumsum(group), side, radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))],
                                              names=["a", "b"])

        for batch in batches:
            g, side, fp = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(3))
            rest.append((g, side, fp.view(np.uint64)))
            g, side, fp = (np.concatenate([r[j] for r in rest]) for j in range(3))
            cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
            if cut:
                yield emit(g[:cut], side[:cut], fp[:cut])
            rest = [(g[cut:], side[cut:], fp[cut:])]
        if rest and len(rest[0][0]):
            yield emit(*rest[0])
    return go


def near_links(nodes: DataFrame, radius: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that span the groups of distinct fingerprints ``fp`` within ``radius`` bits."""
    keyed = nodes.select("fp", F.explode(_keys(radius)).alias("k")).select(F.xxhash64("k.mask", "k.bits").alias("g"), "fp")
    size = persisted(keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    met = keyed.join(size, "g").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = (met.withColumn("x", mine).withColumn("y", other)
           .withColumn("g", F.when(F.col("blocks") == 1, F.col("g"))
                       .otherwise(F.xxhash64("g", F.least("x", "y"), F.greatest("x", "y"))))
           .withColumn("side", F.when(F.col("x") == F.col("y"), 0).when(F.col("x") < F.col("y"), 1).otherwise(2)))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cut.select("g", "side", "fp").repartition(n, "g").sortWithinPartitions("g", "side")
            .mapInArrow(_links(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    radius: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``: the smallest id reachable over links."""
    fps = persisted(fingerprints(docs, doc_id, text, words))
    nodes = persisted(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comps = persisted(connected_components(near_links(nodes.select("fp"), radius, block), "a", "b"))
    label = F.coalesce("component", "fp")
    named = nodes.join(comps, nodes["fp"] == comps["node"], "left").select("fp", "least", label.alias("component"))
    names = persisted(named.groupBy("component").agg(F.min("least").alias("component_id")))
    by_fp = persisted(named.join(names, "component").select("fp", "component_id"))
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")
