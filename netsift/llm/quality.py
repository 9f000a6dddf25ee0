"""Quality rules: cross-document line frequency beside per-document base counts.

Lines are normalised (A-Z folded, outer white space dropped) and hashed. For every host
the number of distinct documents that hold a line is counted over all rows. A line above
either limit is removed: a share of the host's documents (with a small floor, so that a line
of a few documents of a small host stays), or an absolute number of them (so that a hot host,
where a share is thousands of documents, loses its boilerplate too). A document that keeps
too few words is depleted.

One Arrow pass over the texts gives each document's base counts and its distinct line
hashes; it is checkpointed (hashes only, no text), so texts are read once. Counting is
two aggregations, on (line, document) and on lines: the first spreads a hot line over all
tasks, the second collapses it before the shuffle. The lines above the limits are then joined back on a checkpointed
table, so that a hot line's rows can be split between tasks (AQE skew join).

Edge cases: a null or empty text has no words (all counts 0, ``base_failed``); a null
host is a host of its own; a document is an id with a text, so repeated rows count once per
host and are each returned, and copies under other ids count each; a text of any length is
read whole; an empty table gives an empty result; only the named columns are read, so others
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import persisted
from .textops import (FOLD, Chunk, byte_class, doc_index, mix64, prefix_hash, runs, span_hash, sums, text_chunks)

SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
WORD = 1 - SPACE
SYMBOLS = byte_class([(ord(c), ord(c)) for c in "#*$%&|<>"])
NOT_NEWLINE = 1 - byte_class([(10, 10)])
CODE_POINT = 1 - byte_class([(0x80, 0xBF)])  # UTF-8 continuation bytes do not start one

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

_OUT = pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                  ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                  ("text_hash", pa.int64()), ("line_hash", pa.list_(pa.int64())),
                  ("line_words", pa.list_(pa.int32()))])


def _first_of_equal(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key), and a mark on the first of each run of equals in that order."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    first = np.ones(len(order), bool)
    first[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return order, first


def _repeat_words(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Per row, the words inside windows of ``n`` words that occur twice or more in the row."""
    total = len(words)
    if total < n:
        return np.zeros(len(first) - 1, np.int64)
    doc = doc_index(first)
    key = np.zeros(total - n + 1, np.uint64)
    for j in range(n):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[j:total - n + 1 + j]
    inside = doc[:total - n + 1] == doc[n - 1:]
    at = np.flatnonzero(inside)
    # one sort key of row and window: equal windows of different rows stay apart
    k = mix64(key[at] + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(k, kind="stable")
    ks = k[order]
    same = ks[1:] == ks[:-1]
    twice = np.zeros(len(ks), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, hit, 1)
    np.subtract.at(step, hit + n, 1)
    return sums((np.cumsum(step[:-1]) > 0).astype(np.int64), first)


def _lines(c: Chunk, starts: np.ndarray, s_raw: np.ndarray, s_fold: np.ndarray):
    """Lines with a word: row, raw hash, normalised hash, words."""
    nl = np.flatnonzero(c.buf == 10)
    begin = np.unique(np.concatenate([c.offs[:-1], nl + 1]))
    begin = begin[begin < len(c.buf)]
    if not len(begin):
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z.astype(np.uint64), z
    stop = np.minimum(np.append(begin[1:], len(c.buf)), len(c.buf))
    row = np.searchsorted(c.offs, begin, "right") - 1
    first_word = np.searchsorted(starts[0], np.append(begin, len(c.buf)))
    n = np.diff(first_word)
    keep = n > 0
    begin, stop, row, n = begin[keep], stop[keep], row[keep], n[keep]
    fw = first_word[:-1][keep]
    newline_end = c.buf[stop - 1] == 10
    raw = span_hash(s_raw, begin, stop - newline_end)
    norm = span_hash(s_fold, starts[0][fw], starts[1][fw + n - 1])
    return row, raw, norm, n


def _chunk_rows(c: Chunk, rows: np.ndarray) -> pa.RecordBatch:
    starts, ends = runs(c, WORD)
    first = c.per_doc(starts)
    s_raw, s_fold = prefix_hash(c.buf), prefix_hash(c.buf, FOLD)
    points = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(CODE_POINT[c.buf] & WORD[c.buf], out=points[1:])
    words = span_hash(s_raw, starts, ends)
    row, raw, norm, n = _lines(c, (starts, ends), s_raw, s_fold)
    order, new = _first_of_equal(row, raw)
    dup = np.bincount(row[order[~new]], minlength=c.n_docs)
    order, new = _first_of_equal(row, norm)
    at = np.flatnonzero(new)
    line_row = row[order[at]]
    line_words = np.add.reduceat(n[order], at) if len(at) else np.zeros(0, np.int64)
    offsets = pa.array(np.searchsorted(line_row, np.arange(c.n_docs + 1)).astype(np.int32))
    cols = [pa.array(rows),
            pa.array(np.diff(first)),
            pa.array(points[c.offs[1:]] - points[c.offs[:-1]]),
            pa.array(np.diff(c.per_doc(np.flatnonzero(SYMBOLS[c.buf])))),
            pa.array(dup.astype(np.int64)),
            pa.array(_repeat_words(words, first, WINDOW)),
            pa.array(span_hash(s_raw, c.offs[:-1], c.offs[1:]).view(np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(norm[order[at]].view(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(line_words.astype(np.int32)))]
    return pa.RecordBatch.from_arrays(cols, schema=_OUT)


def line_profile(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Base counts and distinct normalised line hashes of each row of ``docs``."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"),
                      F.col(text).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in text_chunks(b.column(2)):
                out = _chunk_rows(c, np.arange(c.lo, c.hi))
                part = b.slice(c.lo, c.n_docs)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *out.columns[1:]],
                                                 names=["doc_id", "host", *_OUT.names[1:]])

    return src.mapInArrow(go, f"doc_id {id_type}, host string, n_words long, word_chars long, n_symbols long, "
                              "n_dup_lines long, n_repeat_words long, text_hash long, line_hash array<long>, "
                              "line_words array<int>")


def frequent_lines(profile: DataFrame, max_share: float, min_docs: int, max_docs: int) -> DataFrame:
    """(``line``) keys of (host, line) pairs held by more than ``max_share`` of the host's
    distinct documents and by at least ``min_docs`` of them, or by more than ``max_docs``."""
    key = F.xxhash64("host", "hash").alias("line")
    docs = profile.withColumn("doc", F.xxhash64("doc_id", "text_hash"))
    held = (docs.select("host", "doc", F.explode("line_hash").alias("hash"))
            .select("host", key, "doc").distinct()
            .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")))
    size = (docs.select("host", "doc").distinct()
            .groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("of")))
    many = F.col("n") > max_docs
    return (held.filter((F.col("n") >= min_docs) | many)
            .join(size, F.col("host").eqNullSafe(F.col("h")))
            .filter(many | (F.col("n") >= min_docs) & (F.col("n") > max_share * F.col("of"))).select("line"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  max_share: float = 0.05, min_docs: int = 5, max_docs: int = 50, min_left_words: int = MIN_WORDS,
                  min_left_share: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: base counts, ``base_failed``, words in removed lines
    (``n_removed_words``) and ``kept``.

    A line is removed when more than ``max_share`` of its host's distinct documents, and at
    least ``min_docs``, hold it, or more than ``max_docs`` whatever their share. A document is
    depleted when lines were removed and fewer than ``min_left_words`` words, or
    ``min_left_share`` of its words, are left.
    """
    prof = persisted(line_profile(docs, doc_id, text, host)
                     .withColumn("row", F.monotonically_increasing_id()))
    hot = persisted(frequent_lines(prof, max_share, min_docs, max_docs))
    lines = (prof.select("row", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("l"))
             .select("row", F.xxhash64("host", "l.line_hash").alias("line"), F.col("l.line_words").alias("w")))
    removed = (lines.join(hot, "line").groupBy("row").agg(F.sum("w").alias("n_removed_words")))
    out = prof.drop("line_hash", "line_words", "text_hash", "host").join(removed, "row", "left")
    gone = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    left = F.col("n_words") - gone
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    depleted = (gone > 0) & ((left < min_left_words) | (left < min_left_share * F.col("n_words")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                      gone.alias("n_removed_words"))
