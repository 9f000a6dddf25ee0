"""Secret scans: credential patterns and a token-efficiency test.

Patterns find assigned credentials, access key ids and long hex runs (the base kinds).
The token-efficiency test adds strings that look random: natural words and identifiers
take few tokens of a trained byte-pair vocabulary, random ones many, so a candidate
string whose characters per token fall below ``max_ratio`` is a span of kind ``random``.
Known digests (hex of a digest's length) and identifiers (UUIDs, numbers, one character
repeated) are left out before the test; letters of one case are tested like any others.

A run of candidate characters is tested whole. Where the whole is not random, plain words
may hide a secret beside them: its parts between ``_ - =`` and between ``/ + _ - =`` are tested,
and within a part every stretch of tokens whose own ratio falls below the limit. Parts and
stretches have the length of a candidate (16) at least.

A vectorised pass over each chunk's bytes marks the texts that can hold a match; only
these become Python strings, and each is searched whole. Spans are code points.

The vocabulary file is a parameter (``vocab_path``); it is read on each executor and
never trained or copied.

Edge cases: a null text is an empty text; several kinds may cover the same characters;
repeated rows are each scanned.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import FOLD, Chunk, byte_class, runs, text_chunks

VOCAB_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# the GPT-2 style pre-tokeniser of that vocabulary (fixed value)
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

KINDS = ("assign", "access", "hex", "random")

# fixed values: the base patterns
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_SECRET, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

MIN_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PARTS = (re.compile(r"[A-Za-z0-9+/]{16,}"), re.compile(r"[A-Za-z0-9]{16,}"))
HEX_ONLY = re.compile(r"[0-9a-fA-F]+\Z")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)  # hex digits of MD5, SHA-1, Tiger, SHA-2
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
NUMBER = re.compile(r"[0-9+/_=-]+\Z")
RULE = re.compile(r"(.)\1*\Z")

_ALNUM_ISH = byte_class([(48, 57), (65, 90), (97, 122)] + [(ord(c), ord(c)) for c in "+/_=-"])
_HEX = byte_class([(48, 57), (97, 102)])
_LETTER = byte_class([(65, 90), (97, 122)])

_encodings: dict[str, object] = {}


def encoding(path: str):
    """The byte-pair encoding of a vocabulary file (kept per process)."""
    if path not in _encodings:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def _identifier(s: str) -> bool:
    """Whether a candidate is a number, a rule, a UUID or hex of a digest's length."""
    return bool(NUMBER.match(s) or RULE.match(s) or UUID.match(s) or HEX_ONLY.match(s) and len(s) in DIGEST_LENGTHS)


def is_random(s: str, enc, max_ratio: float) -> bool:
    """Whether a candidate is no known digest or identifier and tokenises badly."""
    return not _identifier(s) and len(s) < max_ratio * len(enc.encode_ordinary(s))


def _stretches(s: str, enc, max_ratio: float) -> Iterator[tuple[int, int]]:
    """(start, end) of the disjoint stretches of tokens, each the most random of its surroundings."""
    total = best = 0.0
    at = start = stop = 0
    for n in [*(len(enc.decode_single_token_bytes(t)) for t in enc.encode_ordinary(s)), len(s) * (1 + max_ratio)]:
        total += max_ratio - n
        at += n
        if total > best:
            best, stop = total, at
        elif total <= 0:
            if stop - start >= MIN_CANDIDATE and not _identifier(s[start:stop]):
                yield start, stop
            total, best, start, stop = 0.0, 0.0, at, at


def _random_parts(s: str, enc, max_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run: the run, else its parts and their stretches."""
    if _identifier(s):
        return []
    if is_random(s, enc, max_ratio):
        return [(0, len(s))]
    out: list[tuple[int, int]] = []
    for kind in PARTS:
        for m in kind.finditer(s):
            if _identifier(m[0]):
                continue
            new = [(0, len(m[0]))] if is_random(m[0], enc, max_ratio) else _stretches(m[0], enc, max_ratio)
            for a, b in new:
                a, b = a + m.start(), b + m.start()
                if not any(x < b and a < y for x, y in out):
                    out.append((a, b))
    return out


def find_spans(t: str, enc, max_ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span of a text, by start and then by kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= MIN_SECRET]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(t) if len(m[0]) >= MIN_HEX]
    base = list(out)
    for m in CANDIDATE.finditer(t):
        if not any(s <= m.start() and m.end() <= e for _, s, e in base):
            parts = ((a + m.start(), b + m.start()) for a, b in _random_parts(m[0], enc, max_ratio))
            out += [("random", a, b) for a, b in parts if not any(s <= a and b <= e for _, s, e in base)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def suspects(c: Chunk) -> np.ndarray:
    """Texts of the chunk that may hold a span of any kind; every other text has none."""
    hit = np.zeros(c.n_docs, bool)

    def mark(at: np.ndarray) -> None:
        hit[np.searchsorted(c.offs, at, "right") - 1] = True

    low = FOLD[c.buf].tobytes()
    for k in KEYWORDS:
        k = k.encode()
        at = low.find(k)
        while at >= 0:
            d = int(np.searchsorted(c.offs, at, "right")) - 1
            hit[d] = True
            at = low.find(k, max(at + 1, int(c.offs[d + 1]) - len(k) + 1))  # on to the next text
    for member, least in ((_HEX, MIN_HEX), (_ALNUM_ISH, MIN_CANDIDATE)):
        s, e = runs(c, member)
        keep = e - s >= least
        s, e = s[keep], e[keep]
        if member is _ALNUM_ISH and len(s):  # without a letter it is a number
            n = np.zeros(len(c.buf) + 1, np.int32)
            np.cumsum(_LETTER[c.buf], out=n[1:])
            s = s[n[e] > n[s]]
        mark(s)
    raw = c.buf.tobytes()
    at = raw.find(b"AKIA")
    while at >= 0:
        mark(np.array([at]))
        at = raw.find(b"AKIA", at + 1)
    return hit


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocab_path: str = VOCAB_PATH,
         max_ratio: float = 2.0) -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) for each row of ``docs``."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocab_path)
        for b in batches:
            col = b.column(1)
            for c in text_chunks(col):
                found: list = [[]] * c.n_docs
                for r in np.flatnonzero(suspects(c)):
                    found[r] = [{"kind": k, "start": s, "end": e}
                                for k, s, e in find_spans(col[c.lo + int(r)].as_py(), enc, max_ratio)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.lo, c.n_docs), pa.array(found, pa.list_(kind))],
                                                 names=["doc_id", "spans"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(go, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")
