"""Line dedup by a deletion-neighbourhood join.

The unit is a line of at least ``exact_min_chars`` characters (outer blanks and tabs
dropped). Equal lines are one class; its first occurrence, by (doc_id, line number), is
kept. A class of at least ``min_chars`` characters is also dropped when an earlier such
class lies within one edit (a character substituted, inserted or deleted); "earlier"
compares first occurrences. Shorter lines have no one-edit variants: among a few characters
different words lie one edit apart. Every line that is not blank is compared, unless
``exact_min_chars`` says otherwise.

*Neighbourhoods.* Lines one substitution apart become equal when the character at the
same place is deleted from both; lines one insertion apart when it is deleted from the
longer. Each variant is emitted as a hashed key (with the place for substitutions),
computed from prefix hashes in one pass per line. Equal variants are joined with the
earliest line of their key, so a variant shared by many lines gives one pair for
each line and never all pairs. Edit distance is then verified on the texts.

*Which lines emit variants.* One edit leaves one half of a line unchanged, so only lines
that share a half with another line of fitting length can have a partner; a count
over half keys finds them without loss, and they emit variants of the other half only.

Hashes are moved for this, not texts. Only lines with a candidate pair are fetched again
for verification; the last join, which brings line numbers to remove back to documents, moves
each text once.

Edge cases: null texts pass unchanged; rows with equal id and text are one document and
lose the same lines; a null id sorts first; an empty table gives an empty result; the input's
columns travel as one struct, so they may have any name. ``dedup_documents`` drops documents of
which nothing is left, and those of which less than ``min_left_share`` of the characters
of their own distinct lines is left: what remains of a near copy is a fragment, not a
document, while a document that only repeats itself keeps each of its lines once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_filter, packed, persisted
from .textops import byte_class, mix64, powers, prefix_hash, span_hash, text_chunks

MIN_CHARS = 40
MIN_LEFT_SHARE = 0.2
BLANKS = " \t\r"
_LEAD = byte_class([(0, 0x7F), (0xC0, 0xFF)])  # bytes that start a code point


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def lines_of(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, line, n): lines of at least ``min_chars`` characters; th: text hash."""
    return (docs.filter(F.col(text).isNotNull())
            .select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"),
                    F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "raw"))
            .select("doc_id", "th", "pos", _trimmed(F.col("raw")).alias("line"))
            .withColumn("n", F.length("line")).filter(F.col("n") >= min_chars))


def _half_keys(min_chars: int) -> list[Column]:
    """Keys of the unchanged half: for the shorter length m of a pair, the first m // 2
    characters or the last m - m // 2. A line is the shorter (m = n) or the longer (m = n - 1);
    columns k00, k01 (shorter: first, last half), k10, k11 (longer); null under ``min_chars``."""
    n, out = F.col("n"), []
    for d in (0, 1):
        m = n - d
        h = F.floor(m / 2).cast("int")
        out.append(F.when(n >= min_chars, F.xxhash64(F.lit(0), m, F.substring("line", F.lit(1), h))).alias(f"k{d}0"))
        out.append(F.when(n >= min_chars, F.xxhash64(F.lit(1), m, F.right(F.col("line"), m - h))).alias(f"k{d}1"))
    return out


def _line_variants(s: np.ndarray, at: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Hash of a line without the character at each place lo..hi; ``at``: its characters' starts, then its end."""
    pw, ip = powers(len(s))
    start, cut, nxt, stop = at[0], at[lo:hi], at[lo + 1:hi + 1], at[-1]
    left = (s[cut] - s[start]) * ip[start]
    tail = (s[stop] - s[nxt]) * ip[nxt] * pw[cut - start]  # the tail moves down to the gap
    return mix64(left + tail)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lh, first, line, n, d, kind, subst, indel) to variant keys (key, lh, first, role).

    role 0: substitution variant; 1: the shorter line itself; 2: deletion from the longer.
    """
    for b in batches:
        n, d, kind, subst, indel = (b.column(j).to_numpy(zero_copy_only=False) for j in range(3, 8))
        for c in text_chunks(b.column(2)):
            s = prefix_hash(c.buf)
            lead = np.flatnonzero(_LEAD[c.buf])
            first = c.per_doc(lead)
            keys, rows, roles = [], [], []

            def emit(v: np.ndarray, i: int, role: int) -> None:
                keys.append(mix64(v)), rows.append(np.full(len(v), i)), roles.append(np.full(len(v), role, np.int32))

            for r in range(c.n_docs):
                i = c.lo + r
                at = np.append(lead[first[r]:first[r + 1]], c.offs[r + 1])
                m = int(n[i]) - int(d[i])  # characters of the shorter line of the pair
                # places outside the half that is equal
                lo, hi = (m // 2, int(n[i])) if kind[i] == 0 else (0, int(n[i]) - (m - m // 2))
                if d[i] == 0 and subst[i]:
                    place = np.arange(lo, hi).astype(np.uint64) + np.uint64(1)
                    emit(_line_variants(s, at, lo, hi) + place * np.uint64(0xD6E8FEB86659FD93), i, 0)
                if d[i] == 0 and indel[i]:
                    emit(span_hash(s, at[:1], at[-1:]), i, 1)
                if d[i] == 1 and indel[i]:
                    emit(_line_variants(s, at, lo, hi), i, 2)
            if keys:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), b.column(0).take(take), b.column(1).take(take),
                     pa.array(np.concatenate(roles))], names=["key", "lh", "first", "role"])


def _may_pair(classes: DataFrame) -> DataFrame:
    """(lh, first, d, kind, subst, indel): classes that share a half with another of fitting length."""
    halves = classes.select("lh", "first", F.explode(F.array(*(
        F.struct(F.col(f"k{d}{k}").alias("key"), F.lit(d).alias("d"), F.lit(k).alias("kind"))
        for d in (0, 1) for k in (0, 1)))).alias("h")).select("lh", "first", "h.*")
    n0, n1 = (F.sum((F.col("d") == d).cast("long")) for d in (0, 1))
    met = (halves.groupBy("key").agg(n0.alias("n0"), n1.alias("n1"))
           .select("key", (F.col("n0") > 1).alias("subst"), ((F.col("n0") > 0) & (F.col("n1") > 0)).alias("indel"))
           .filter(F.col("subst") | F.col("indel")))
    met = persisted(met)
    return bucket_filter(halves, "key", met).join(met, "key").drop("key")


def _earliest_partner(variants: DataFrame) -> DataFrame:
    """(lh, plh): for each line, the earliest fitting line of each of its variant keys."""
    short, item = F.col("role") == 1, F.struct("first", "lh")
    least = variants.groupBy("key").agg(F.min(F.when(short, item)).alias("short"),
                                        F.min(F.when(~short, item)).alias("rest"))
    partner = F.when(F.col("role") == 2, F.col("short")).otherwise(F.col("rest"))
    return (variants.join(persisted(least), "key").withColumn("p", partner)
            .filter(F.col("p.first") < F.col("first")).select("lh", F.col("p.lh").alias("plh")).distinct())


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
             exact_min_chars: int = 1) -> DataFrame:
    """(doc_id, th, pos, near): every line occurrence to remove; ``near`` tells that its class
    has an earlier class within one edit, else it repeats its own class.

    ``min_chars`` bounds the one-edit search, ``exact_min_chars`` the exact repeats."""
    lines = lines_of(docs, doc_id, text, min(min_chars, exact_min_chars)).withColumn("lh", F.xxhash64("line"))
    place = F.struct("doc_id", "pos", "th")
    keys = [f"k{d}{k}" for d in (0, 1) for k in (0, 1)]
    classes = persisted(lines.select("lh", place.alias("place"), *_half_keys(min_chars)).groupBy("lh")
                        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_lines"),
                             *(F.max(k).alias(k) for k in keys)))
    wanted = persisted(_may_pair(classes.filter(F.col("k00").isNotNull())))
    need = persisted(wanted.select("lh").distinct())
    texts = persisted(bucket_filter(lines.select("lh", "line", "n"), "lh", need).join(need, "lh", "left_semi")
                      .dropDuplicates(["lh"]))
    cols = ["lh", "first", "line", "n", "d", "kind", "subst", "indel"]
    src = wanted.join(texts, "lh").select(*cols)
    first_type = src.schema["first"].dataType.simpleString()
    # few variants meet another: only these are stored, the others are counted and made again
    variants = src.mapInArrow(_variants, f"key long, lh long, first {first_type}, role int")
    met = persisted(variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key"))
    variants = persisted(bucket_filter(variants, "key", met).join(met, "key"))
    near = (_earliest_partner(variants)
            .join(texts.select("lh", F.col("line").alias("a")), "lh")
            .join(texts.select(F.col("lh").alias("plh"), F.col("line").alias("b")), "plh")
            .filter(F.levenshtein("a", "b", 1) == 1).select("lh").distinct().withColumn("near", F.lit(True)))
    drop = persisted(classes.select("lh", "first", "n_lines").join(near, "lh", "left")
                     .withColumn("near", F.coalesce("near", F.lit(False)))
                     .filter((F.col("n_lines") > 1) | F.col("near")).select("lh", "first", "near"))
    return (bucket_filter(lines.select("lh", "doc_id", "th", "pos"), "lh", drop).join(drop, "lh")
            .filter(F.col("near") | ~place.eqNullSafe(F.col("first"))).select("doc_id", "th", "pos", "near"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                exact_min_chars: int = 1) -> DataFrame:
    """(row, clean, n_lines, n_exact, n_near): the columns of ``docs`` as a struct, the text without
    its repeated lines, its lines, and how many of them went as exact repeats and as one-edit variants."""
    gone = (removals(docs, doc_id, text, min_chars, exact_min_chars).groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"))
            .agg(F.collect_set(F.struct("pos", "near")).alias("gone")))
    src = docs.select(packed(docs).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("body"),
                      F.xxhash64(F.col(text)).alias("th"))
    out = src.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
    all_lines = F.split("body", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone.pos"))
    cleaned = F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")
    hit = F.col("gone").isNotNull()
    n_gone = F.when(hit, F.size("gone")).otherwise(0).cast("long")
    near = F.when(hit, F.size(F.filter("gone", lambda x: x["near"]))).otherwise(0).cast("long")
    n = F.when(F.col("body").isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    return out.select("row", F.when(hit, cleaned).otherwise(F.col("body")).alias("clean"), n.alias("n_lines"),
                      (n_gone - near).alias("n_exact"), near.alias("n_near"))


def dedup_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                    n_chars: str | None = "n_chars", exact_min_chars: int = 1,
                    min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """``docs`` with repeated lines of every non-blank length removed, without the documents of which only
    white space, or less than ``min_left_share`` of the characters of their distinct lines, is left.

    Columns stay as they are; ``n_chars`` (if there) is counted anew for changed texts.
    """
    d = dedup_lines(docs, doc_id, text, min_chars, exact_min_chars)
    changed = F.col("n_exact") + F.col("n_near") > 0

    def size(c: Column) -> Column:  # characters of the distinct lines
        return F.length(F.array_join(F.array_distinct(F.transform(F.split(c, "\n", -1), _trimmed)), ""))

    enough = F.col("clean").rlike(r"\S") & (size(F.col("clean")) >= min_left_share * size(F.col("row")[text]))
    new = {text: F.col("clean")}
    if n_chars in docs.columns:
        new[n_chars] = F.when(changed, F.length("clean").cast(docs.schema[n_chars].dataType)).otherwise(F.col("row")[n_chars])
    return d.filter(~changed | enough).select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
