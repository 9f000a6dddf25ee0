"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, chat, decontam, gam, langid, licenses, linededup, mixing, quality, ranked, secrets, simhash,
               toxicity)
from .common import fold_of, table

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        BUILDERS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def joined(items: Column) -> Column:
    """Comma-joined items; null without any."""
    return F.array_join(items, ",")


# --- 1: quality rules -------------------------------------------------------------------

_RX_WORD = r"[^\x20\x09-\x0D]+"
OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '{_RX_WORD}')) AS w,
             generate_subscripts(regexp_extract_all(text, '{_RX_WORD}'), 1) AS i FROM d),
n AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r),
g AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o
             || ' ' || lead(w, 4) OVER o AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g WHERE g IS NOT NULL) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM t, range(5) AS s(k) GROUP BY r),
l AS (SELECT r, doc_id, source, md5(text) AS th, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT *, len(regexp_extract_all(line, '{_RX_WORD}')) AS words,
              translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
       FROM l WHERE regexp_matches(line, '{_RX_WORD}')),
dup AS (SELECT r, sum(c - 1) AS n FROM (SELECT r, line, count(*) AS c FROM lw GROUP BY r, line) GROUP BY r),
held AS (SELECT source, norm, count(DISTINCT (doc_id, th)) AS n FROM lw GROUP BY source, norm),
host AS (SELECT source, count(DISTINCT (doc_id, md5(text))) AS n FROM d GROUP BY source),
hot AS (SELECT held.source, norm FROM held JOIN host ON held.source IS NOT DISTINCT FROM host.source
        WHERE held.n > 50 OR held.n >= 5 AND held.n > 0.05 * host.n),
gone AS (SELECT r, sum(words) AS n FROM lw JOIN hot ON lw.source IS NOT DISTINCT FROM hot.source AND lw.norm = hot.norm
         GROUP BY r),
b AS (SELECT d.doc_id, coalesce(n.n_words, 0)::BIGINT AS n_words, coalesce(n.word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(gone.n, 0)::BIGINT AS n_removed_words
      FROM d LEFT JOIN n USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_words - n_removed_words AS kept_words
      FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_removed_words > 0 AND (kept_words < 10 OR kept_words < 0.5 * n_words)) AS kept,
       n_removed_words
FROM f"""


@register("op1_quality_rules", OP1_SQL)
def op1(spark, sf):
    return quality.quality_rules(table(spark, sf, "documents"))


# --- 2: language identification ----------------------------------------------------------


@register("op2_language_id")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, fold_of("doc_id", 3) != 1)
    return langid.identify(docs, model).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


# --- 3: mixing ---------------------------------------------------------------------------

OP3_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_RX_WORD}')) AS n_tokens FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS total FROM d GROUP BY source),
t AS (SELECT list(total::DOUBLE / (SELECT sum(total) FROM s) ORDER BY source NULLS FIRST) AS p FROM s),
e AS (SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
      UNION ALL
      SELECT k + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
      FROM (SELECT k, lo, hi, list_sum(list_transform(q, lambda x: CASE WHEN x > 0 THEN -x * ln(x) ELSE 0 END))
                   >= 0.95 * ln(len(list_filter(q, lambda x: x > 0))) AS ok
            FROM (SELECT k, lo, hi, list_transform(r, lambda x: x / list_sum(r)) AS q
                  FROM (SELECT k, lo, hi, list_transform(p, lambda x: CASE WHEN x > 0 THEN pow(x, (lo + hi) / 2) ELSE 0 END) AS r
                        FROM e, t WHERE k < 60)))),
a AS (SELECT CASE WHEN (SELECT list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN -x * ln(x) ELSE 0 END))
                        >= 0.95 * ln(len(list_filter(p, lambda x: x > 0))) FROM t) THEN 1.0
             ELSE floor((SELECT lo FROM e WHERE k = 60) * 1e6) / 1e6 END AS a),
w AS (SELECT source, total, round(pow(total::DOUBLE / (SELECT sum(total) FROM s), a.a)
             / (SELECT list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN pow(x, a.a) ELSE 0 END)) FROM t), 9) AS weight
      FROM s, a),
b AS (SELECT *, floor(weight * (SELECT sum(total) FROM s))::BIGINT AS budget FROM w),
per AS (SELECT doc_id, d.source, n_tokens, weight, total, budget, unnest(range(0, coalesce(budget // nullif(total, 0), 0) + 1)) AS epoch
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
o AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch
             ORDER BY md5('17-' || epoch || '-' || coalesce(doc_id::VARCHAR, ''))
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM per),
r AS (SELECT doc_id, source, n_tokens, epoch, start // 65536 AS block, start, weight FROM o
      WHERE total = 0 OR epoch < budget // total OR start < budget - (budget // total) * total),
k AS (SELECT DISTINCT source, epoch, block FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY epoch, block) - 1 AS j, count(*) OVER (PARTITION BY source) AS m FROM k),
u AS (SELECT source, epoch, block, row_number() OVER (ORDER BY (j * 2 + 1)::DOUBLE / (m * 2),
             md5('17-' || coalesce(source, '') || '-' || epoch || '-' || block), source) - 1 AS turn FROM n)
SELECT r.*, turn FROM r JOIN u ON r.source IS NOT DISTINCT FROM u.source AND r.epoch = u.epoch AND r.block = u.block"""


@register("op3_mix_sources", OP3_SQL)
def op3(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


# --- 4: benchmark decontamination ----------------------------------------------------------

# Windows are compared as word lists; DuckDB takes them from the texts of documents and items.
_RX_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_RX_TERM}') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, '{_RX_TERM}') AS w FROM benchmark),
ph AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS g, least(len(w), 13) AS n
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM ph),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, dw.n, i, item FROM dw JOIN ph ON dw.g = ph.g AND dw.n = ph.n),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, n, i FROM m), range(13) AS x(k) WHERE k < n GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r),
-- proximity: a start from which every term stands within 2 words of its place
pg AS (SELECT row_number() OVER () AS p, g, n, string_split(g, ' ') AS ts FROM (SELECT DISTINCT g, n FROM ph)),
pt AS (SELECT p, n, unnest(ts) AS t, generate_subscripts(ts, 1) AS j FROM pg),
wp AS (SELECT r, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
full_pairs AS (SELECT r, p FROM (SELECT DISTINCT r, t FROM wp) JOIN
               (SELECT DISTINCT p, unnest(ts) AS t, len(list_distinct(ts)) AS k FROM pg) USING (t) GROUP BY r, p
               HAVING count(*) = any_value(k)),
st AS (SELECT DISTINCT f.r, f.p, n, j, i - j + x AS s FROM full_pairs f JOIN pt USING (p) JOIN wp ON wp.r = f.r AND wp.t = pt.t, range(-2, 3) AS y(x)),
near_p AS (SELECT DISTINCT r, p FROM (SELECT r, p FROM st GROUP BY r, p, n, s HAVING count(*) = n)),
ni AS (SELECT r, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_items
       FROM (SELECT DISTINCT r, item FROM near_p JOIN pg USING (p) JOIN ph USING (g, n)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near, sha256(coalesce(near_items, '')) AS near_sha256
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r) LEFT JOIN ni USING (r)"""


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


@register("op4_decontaminate", OP4_SQL)
def op4(spark, sf):
    found = decontam.find_phrases(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(joined(F.col("items")), 256).alias("items_sha256"), contaminated().alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near"), F.sha2(joined(F.col("near_items")), 256).alias("near_sha256"))


# --- 5: secret scans -----------------------------------------------------------------------


@register("op5_secret_scan")
def op5(spark, sf):
    found = secrets.scan(table(spark, sf, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def line(spans: Column) -> Column:
        return joined(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = secrets.KINDS[:3]
    return found.select("doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base),
                        F.sha2(line(of(*base)), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


# --- 6: toxicity ---------------------------------------------------------------------------


@register("op6_toxicity")
def op6(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), fold_of("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# --- 7: SimHash near-duplicates --------------------------------------------------------------


@register("op7_simhash_near_dedup")
def op7(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- 8: chat formatting ----------------------------------------------------------------------

_ESC = r"replace(replace(replace(replace({0}, '\', '\e'), '<', '\l'), '[', '\b'), '|', '\p')"
OP8_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(8 + length({_ESC.format('role')}) + length({_ESC.format('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""
PROBE = "</s>[INST] ok [/INST]"


@register("op8_chat_format", OP8_SQL)
def op8(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    done = chat.format_trees(chat.linear(rows.unionByName(probe)))
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = chat.text_under(F.col("formatted"), F.col("loss"))
    return done.select(F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"),
                       F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.length(under).cast("long").alias("loss_chars"), F.sha2(under, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# --- 9: licence scans ------------------------------------------------------------------------


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(c: str) -> str:
    c = f"lower({c})"
    for a, b in licenses.EQUIVALENT:
        c = f"replace({c}, {_sql_text(a)}, {_sql_text(b)})"
    c = rf"regexp_replace({c}, '(?m)^[ \t]*(?:#+|//+|/?\*+|--+|;+|%+)[ \t]*(copyright|\(c\)|all rights reserved)', '\1', 'g')"
    c = f"regexp_replace({c}, {_sql_text(licenses.COPYRIGHT_LINE)}, '', 'g')"
    return rf"regexp_replace({c}, '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')"


_ONE_LINE = r"trim(regexp_replace({0}, '[ \n]+', ' ', 'g'), ' ')"
_PARAGRAPHS = rf"list_filter(list_transform(string_split_regex(c, '\n ?\n'), lambda x: {_ONE_LINE.format('x')}), lambda x: x <> '')"
OP9_SQL = rf"""
WITH k(license_id, t) AS (VALUES {', '.join(f'({_sql_text(i)}, {_sql_text(t)})' for i, t in licenses.KNOWN)}),
kc AS (SELECT license_id, {_canonical_sql('t')} AS c FROM k),
known AS (SELECT DISTINCT license_id, {_ONE_LINE.format('c')} AS t FROM kc),
kp AS (SELECT DISTINCT ps[1] AS head, len(ps) AS n FROM (SELECT {_PARAGRAPHS} AS ps FROM kc) WHERE len(ps) > 1),
c AS (SELECT doc_id, {_canonical_sql('text')} AS c FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, 'document' AS unit, c AS t FROM c
      UNION ALL SELECT doc_id, 'paragraph', unnest(string_split_regex(c, '\n ?\n')) FROM c WHERE regexp_matches(c, '\n ?\n')
      UNION ALL SELECT doc_id, 'line', unnest(string_split(c, chr(10))) FROM c
      UNION ALL SELECT doc_id, 'paragraphs', array_to_string(ps[i:i + n - 1], ' ')
      FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_PARAGRAPHS} AS ps FROM c)) p
      JOIN kp ON ps[i] = head AND n < len(ps) AND i + n - 1 <= len(ps))
SELECT doc_id, unit, license_id, count(*) AS n
FROM u JOIN known ON {_ONE_LINE.format('u.t')} = known.t GROUP BY doc_id, unit, license_id"""


@register("op9_license_scan", OP9_SQL)
def op9(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


# --- 10: line dedup --------------------------------------------------------------------------

# One edit apart, found by the equal half and the equal rest: no deletion variants here.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, text, md5(text) AS th, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, th, pos, line FROM (
        SELECT doc_id, th, pos - 1 AS pos, trim(ls[pos], ' ' || chr(9) || chr(13)) AS line
        FROM (SELECT doc_id, th, ls, unnest(range(1, len(ls) + 1)) AS pos FROM d WHERE text IS NOT NULL))
      WHERE length(line) >= 1),
cl AS (SELECT line, length(line) AS n, min({'a': doc_id, 'b': pos}) AS first FROM l GROUP BY line),
h AS (SELECT line, n, first, n - k AS m, k, 0 AS kind, substr(line, 1, (n - k) // 2) AS half FROM cl, range(2) AS r(k) WHERE n >= 40
      UNION ALL SELECT line, n, first, n - k, k, 1, right(line, (n - k) - (n - k) // 2) FROM cl, range(2) AS r(k) WHERE n >= 40),
p AS (SELECT DISTINCT a.line AS x, a.first AS xf, b.line AS y, b.first AS yf
      FROM h a JOIN h b ON a.m = b.m AND a.kind = b.kind AND a.half = b.half AND a.line <> b.line AND a.k = 0),
one AS (SELECT * FROM p WHERE len(list_filter(range(0, length(x) + 1), lambda i: substr(x, 1, i) = substr(y, 1, i)
          AND substr(y, i + 2) = substr(x, CASE WHEN length(x) = length(y) THEN i + 2 ELSE i + 1 END))) > 0),
near AS (SELECT DISTINCT CASE WHEN xf > yf THEN x ELSE y END AS line FROM one),
gone AS (SELECT l.doc_id, l.th, l.pos, l.line IN (SELECT line FROM near) AS near
         FROM l JOIN cl USING (line)
         WHERE l.line IN (SELECT line FROM near) OR NOT (l.doc_id = cl.first.a AND l.pos = cl.first.b)),
g AS (SELECT doc_id, th, list(DISTINCT pos) AS gone, count(DISTINCT pos) FILTER (WHERE near) AS n_near FROM gone GROUP BY doc_id, th)
SELECT d.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, (coalesce(len(gone), 0) - coalesce(n_near, 0))::BIGINT AS n_exact,
       coalesce(n_near, 0)::BIGINT AS n_near,
       sha256(CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE array_to_string(
           list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(gone, i - 1)), lambda i: ls[i]), chr(10)) END)
           AS text_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id AND d.th = g.th"""


@register("op10_line_dedup", OP10_SQL)
def op10(spark, sf):
    done = linededup.dedup_lines(table(spark, sf, "documents"))
    return done.select("row.doc_id", "n_lines", "n_exact", "n_near",
                       F.sha2(F.coalesce("clean", F.lit("")), 256).alias("text_sha256"))


# --- 11: ranked lexical search ---------------------------------------------------------------

_RX_RANKED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_RX_RANKED}') AS w FROM documents),
st AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
it AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, '{_RX_RANKED}') AS w
       FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qt AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM it) GROUP BY q, t),
wt AS (SELECT t, floor(1000 * ln((2 * (SELECT n FROM st) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
       FROM tf WHERE t IN (SELECT t FROM qt) GROUP BY t),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w)::BIGINT * (SELECT n FROM st)) // (SELECT l FROM st) AS m FROM d WHERE len(w) > 0),
s AS (SELECT q, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM qt JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY q, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k JOIN it USING (q) WHERE rank <= 10"""


@register("op11_ranked_search", OP11_SQL)
def op11(spark, sf):
    return ranked.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# --- 12: quality classifier ------------------------------------------------------------------


@register("op12_quality_gam")
def op12(spark, sf):
    docs = table(spark, sf, "documents")
    model = gam.fit(docs, table(spark, sf, "labels"), fold_of("doc_id", 3) != 1)
    return gam.score(docs, model).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# --- 13: filter interaction audit ------------------------------------------------------------

_LETTERS = [f"substr(filter_order, {i}, 1)" for i in range(1, 6)]
OP13_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{_RX_WORD}') AS w FROM documents),
lb AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             MAP {{'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
                  'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
                  'D': regexp_matches(text, '[#$%&*|]'),
                  'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)}} AS fails
      FROM d LEFT JOIN lb ON d.doc_id = lb.doc_id),
l(a) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.a || q.a || r.a || s.a || t.a AS filter_order FROM l p, l q, l r, l s, l t
      WHERE len(list_distinct([p.a, q.a, r.a, s.a, t.a])) = 5),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
g AS (SELECT *, coalesce(list_position([{', '.join(f'fails[{x}]' for x in _LETTERS)}], true), 6) AS goes FROM c, o),
s AS (SELECT *, fails[substr(filter_order, step, 1)] AS hit FROM g, range(1, 6) AS x(step)),
t AS (SELECT part, filter_order, step::INTEGER AS step, coalesce(sum(n) FILTER (WHERE goes > step), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (WHERE goes = step), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (WHERE hit AND goes < step), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (WHERE hit AND len(list_filter(map_values(fails), lambda x: x)) = 1), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (WHERE goes = step), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE goes = step), 0)::BIGINT AS toxic_lost
      FROM s GROUP BY part, filter_order, step)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM t"""


@register("op13_filter_audit", OP13_SQL)
def op13(spark, sf):
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
