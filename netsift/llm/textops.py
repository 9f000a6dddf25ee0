"""NumPy helpers over whole Arrow string columns: chunking, byte tokenising, hashing.

Operators that run inside ``mapInArrow`` read the UTF-8 buffer of a whole batch at once
instead of one Python string per row. ``text_chunks`` cuts a batch into runs of
documents of a few MB (a longer document is a chunk of its own), so a task's memory is
bounded by the chunk size plus its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_P = 0x9E3779B97F4A7C15  # odd multiplier of the polynomial hash
_M = (1 << 64) - 1
_pow = np.ones(1, np.uint64)
_ipow = np.ones(1, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _M, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``P**i`` and ``P**-i`` modulo 2**64 for i < n (kept per process)."""
    global _pow, _ipow
    if len(_pow) < n:
        size = max(n, CHUNK_BYTES + 1, 2 * len(_pow))
        _pow, _ipow = _powers(_P, size), _powers(pow(_P, -1, 1 << 64), size)
    return _pow[:n], _ipow[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))  # one 64-bit value per byte


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """256-entry 0/1 table that is 1 on the given inclusive byte ranges."""
    t = np.zeros(256, np.uint8)
    for lo, hi in ranges:
        t[lo:hi + 1] = 1
    return t


def fold_az() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


FOLD = fold_az()


@dataclass
class Chunk:
    lo: int                # first row of the batch in this chunk
    hi: int                # one past the last row
    buf: np.ndarray        # uint8 bytes of all texts, end to end
    offs: np.ndarray       # int64 start of each text in buf, plus the end

    @property
    def n_docs(self) -> int:
        return self.hi - self.lo

    def per_doc(self, positions: np.ndarray) -> np.ndarray:
        """Index of the first of the sorted ``positions`` in each text, plus the end."""
        return np.searchsorted(positions, self.offs)


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a string column as chunks of about ``limit`` bytes (null: empty text)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, ob, db = col.buffers()
    offs = np.frombuffer(ob, width)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(db, np.uint8) if db is not None and db.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


def runs(c: Chunk, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes; a run never crosses texts."""
    n = len(c.buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    m = member[c.buf]
    first = m.copy()
    first[1:] &= m[:-1] ^ 1
    last = m.copy()
    last[:-1] &= m[1:] ^ 1
    cut = c.offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = m[cut]
    last[cut - 1] = m[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def prefix_hash(buf: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums of the polynomial hash; see ``span_hash``."""
    values = BYTE_VALUES if fold is None else BYTE_VALUES[fold]
    p, _ = powers(len(buf) + 1)
    s = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * p[:-1], out=s[1:])
    return s


def span_hash(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal bytes give equal values wherever they stand."""
    _, ip = powers(len(s))
    return mix64((s[ends] - s[starts]) * ip[starts])


def doc_index(first: np.ndarray) -> np.ndarray:
    """Row of each item, from the first-item index of each row plus the end."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each row, rows given by first-item indexes plus the end."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def hash_words(words: list[str]) -> np.ndarray:
    """``span_hash`` of each given string (A-Z are not folded here)."""
    raw = [w.encode() for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    starts = ends - np.array([len(r) for r in raw], np.int64) if raw else ends
    return span_hash(prefix_hash(buf), starts, ends)
