"""Ranked search, quality model and filter audit against plain Python on odd and random rows."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import W, fold, words
from pyspark.sql import functions as F

from netsift.llm import audit, gam, ranked, textops

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_ranks(rows, items, k=10):
    docs = [(i, Counter(TERM.findall(fold(t)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total, df = len(docs), sum(x[2] for x in docs), Counter(t for _, c, _ in docs for t in c)
    out = set()
    for item, text in set(items):
        asked, scores = Counter(TERM.findall(fold(text))), []
        for r, (i, c, length) in enumerate(docs):
            m = 25 + 75 * length * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, r, i))
        out |= {(item, rank + 1, s[4], -s[0]) for rank, s in enumerate(sorted(scores)[:k])}
    return out


def rows_of(df):
    return {(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("segment", [1, 150, 1 << 20])
def test_ranked_search_brute_force(spark, seed, segment):
    rng = random.Random(seed)
    vocab = [words(rng, 1) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocab[:rng.choice([3, 60])]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(i, rows[7][1]) for i in range(500, 540)] + [(900, None), (901, "?!"), rows[3], rows[3]]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 30)))) for i in range(12)]
    items += [items[0], (0, "another " + vocab[0]), (50, None), (51, ""), (52, "nowhere"), (None, vocab[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = ranked.search(docs, bench, segment_postings=segment, block_terms=60, pilot_every=2)
    assert rows_of(got) == brute_ranks(rows, items)
    assert got.count() == len(got.dropDuplicates(["item_id", "rank", "doc_id", "score"]).collect())


def test_ranked_search_odd_rows(spark, edge, edge_rows, empty):
    bench = edge.selectExpr("doc_id AS item_id", "text", "score AS rank", "fp AS q")
    items = [(r[0], r[1]) for r in edge_rows]
    assert rows_of(ranked.search(edge, bench)) == brute_ranks([(r[0], r[1]) for r in edge_rows], items)
    assert ranked.search(empty, bench).collect() == []
    assert ranked.search(edge, bench.limit(0)).collect() == []


def test_nra_against_full_scores():
    rng = np.random.default_rng(0)
    for _ in range(400):
        n, k = int(rng.integers(1, 40)), int(rng.integers(1, 8))
        lists, full = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(0, 8))):
            d = np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False))
            imp, w = rng.integers(1, rng.choice([4, 50, 1000]), len(d)), int(rng.integers(1, 9))
            by = np.lexsort((d, -imp))
            lists.append((w, d[by], imp[by]))
            full[d] += w * imp
        floor = int(rng.integers(0, 30))
        order = [int(x) for x in np.lexsort((np.arange(n), -full)) if full[x] > 0][:k]
        want = [x for x in order if full[x] >= floor]
        got, score = ranked.nra(lists, n, k, floor)
        assert got.tolist() == want and score.tolist() == full[want].tolist()


def test_normalisers_do_not_overflow():
    lengths = np.array([1, 10 ** 7, 10 ** 9])
    assert ranked.normalisers(lengths, 10 ** 10, 10 ** 13).tolist() == [25 + 75 * int(x) * 10 ** 10 // 10 ** 13 for x in lengths]


# --- quality classifier ------------------------------------------------------------------


def plain_features(t):
    t = t or ""
    w = W.findall(t)
    n, size, low = max(len(w), 1), max(len(t), 1), [fold(x) for x in w]
    lens = [len(x) for x in w]
    mean = sum(lens) / n
    lines = [x for x in t.split("\n") if x]
    fl = [fold(x) for x in lines]

    def repeats(items):
        return 1 - len(set(items)) / len(items) if items else 0.0

    def share(chars):
        return sum(c in chars for c in t) / size

    letters = {"A-Z": [chr(i) for i in range(65, 91)], "0-9": "0123456789"}
    symbols, ends = "#$%&*|<>@^~_=+\\{}[]", [x.encode()[-1:] for x in w]
    high = sum(b >= 0x80 for b in t.encode()) / size
    return [math.log1p(len(w)), mean, math.sqrt(max(sum(x * x for x in lens) / n - mean * mean, 0)), share(letters["A-Z"]),
            share(letters["0-9"]), share(symbols), high, share(",;:"), share(".!?"), share("!"),
            sum("A" <= x[0] <= "Z" for x in w) / n,
            sum(e in [s.encode() for s in symbols] or x.endswith("!!") or x == "!" for e, x in zip(ends, w)) / n,
            sum(x[-1] in ".!?" for x in w) / n, len(set(low)) / n, repeats([tuple(low[i:i + 2]) for i in range(len(w) - 1)]),
            repeats([tuple(low[i:i + 5]) for i in range(len(w) - 4)]), max(Counter(low).values(), default=0) / n,
            math.log1p(len(lines)), math.log1p(len(w) / max(len(lines), 1)), repeats(fl),
            sum(x <= 2 for x in lens) / n, sum(x >= 12 for x in lens) / n]


def test_gam_features_are_the_plain_ones(edge_rows):
    rng = random.Random(4)
    texts = [r[1] for r in edge_rows] + [words(rng, rng.randint(0, 60)).title() + rng.choice(["!!", "#", " a a a", "\n\nx y\nx y"]) for _ in range(40)]
    got = np.vstack([gam.features(c) for c in textops.text_chunks(pa.array(texts), 5000)])
    assert got.shape == (len(texts), len(gam.FEATURES))
    np.testing.assert_allclose(got, [plain_features(t) for t in texts], atol=1e-9)


def plain_margin(m, x):
    z = m.intercept
    for f, cut in enumerate(m.cuts):
        z += m.tables[f][sum(x[f] > c for c in cut)]
    for (a, b), t in zip(m.pairs, m.pair_tables):
        z += t[sum(x[a] > c for c in m.pair_cuts[a])][sum(x[b] > c for c in m.pair_cuts[b])]
    return z


def test_gam_learns_main_effects_and_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((3000, 5))
    x[:, 4] = rng.integers(0, 3, 3000)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # an interaction only
    held = np.arange(3000) % 5 == 0
    m = gam.boost(x[:2000], y[:2000], np.ones(2000), held[:2000])
    assert m.pairs[0] == (0, 1)
    z = m.margin(x)
    np.testing.assert_allclose(z[:50], [plain_margin(m, r) for r in x[:50]], atol=1e-9)
    assert ((z[2000:] > 0) == (y[2000:] == 1)).mean() > 0.9
    y = (x[:, 2] + 0.1 * rng.normal(size=3000) > 0.6).astype(float)
    m = gam.boost(x[:2000], y[:2000], np.ones(2000), held[:2000])
    assert ((m.margin(x[2000:]) > 0) == (y[2000:] == 1)).mean() > 0.85


def test_shallow_tree_is_the_best_split():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(2, 10))
        g, h = rng.normal(size=n), rng.random(n) + 1
        t = gam.shallow_tree(g, h, 2, 1.0, 0.0)
        gains = {c: sum(v[s].sum() ** 2 / (u[s].sum() + 1) for v, u, s in ((g, h, slice(0, c)), (g, h, slice(c, n)))) for c in range(1, n)}
        if len(set(t)) > 1:
            c = int(np.flatnonzero(np.diff(t))[0]) + 1
            assert gains[c] == pytest.approx(max(gains.values()))
            assert t[0] == pytest.approx(-g[:c].sum() / (h[:c].sum() + 1))


def test_gam_query_held_out_and_odd_rows(spark, edge, empty):
    rng = random.Random(9)
    rows = [(i, words(rng, 60) if i % 2 else " ".join(w + "##" for w in words(rng, 60).split())) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(1, None), (None, 1), (2, 0)], "doc_id long, quality int")
    m = gam.fit(docs, labels, F.col("doc_id") % 3 != 1)
    again = gam.fit(docs.repartition(7), labels, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r.score for r in gam.score(docs, m).collect()}
    assert all((s >= 0.5) == (i % 2 == 1) for i, s in got.items() if i % 3 == 1)
    assert got == {r.doc_id: r.score for r in gam.score(docs, again).collect()}
    odd = gam.score(edge, m).collect()
    assert len(odd) == edge.count() and all(0 <= r.score <= 1 for r in odd)
    assert gam.score(empty, m).collect() == []
    one = gam.fit(docs, labels.filter("quality = 1"), F.col("doc_id") % 3 != 1)
    assert {r.score for r in gam.score(docs, one).collect()} == {1.0}
    none = gam.fit(empty, labels.limit(0), F.col("doc_id") % 3 != 1)
    assert {r.score for r in gam.score(docs, none).collect()} == {0.0}


# --- filter audit --------------------------------------------------------------------------


def brute_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[j] == 1} for j in (0, 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = W.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        docs.append((lang or "", {k for k, v in f.items() if v}, i in good, i in toxic))
    out, shares = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d[1:] for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                redundant = sum(x in d[0] for d in mine) - len(gone)
                left = [d for d in left if x not in d[0]]
                out[part, "".join(order), step] = (len(left), len(gone), redundant, sum(d[0] == {x} for d in mine),
                                                   sum(d[1] for d in gone), sum(d[2] for d in gone))
                shares[part, x] += len(gone)
    return {(p, o, s, *v, shares[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audit_rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_brute_force(spark, seed):
    rng = random.Random(seed)
    def text():
        w = [words(rng, 1) for _ in range(rng.choice([5, 150]))]
        return " ".join(rng.choice(w) for _ in range(rng.choice([3, 199, 200, 260]))) + rng.choice(["", "#", "ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3])
    rows = [(i, text(), rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(100 + i, rows[rng.randint(0, 20)][1], rng.choice(["en", "fr"])) for i in range(60)]
    rows += [(300 + i, None if i % 2 else "", "en") for i in range(6)] + [(None, rows[0][1], "en"), (None, None, None), rows[5], rows[5]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)] + [(0, 1, 1), (None, 1, 1)]
    rng.shuffle(rows)
    got = audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4),
                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert audit_rows(got) == brute_audit(rows, labels)


def test_audit_odd_rows(spark, edge, edge_rows, empty):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert audit_rows(audit.audit(edge, labels)) == brute_audit([r[:3] for r in edge_rows], [(1, 1, 0)])
    assert audit.audit(empty, labels).collect() == []
    assert audit.audit(edge, labels.limit(0)).count() == audit.audit(edge, labels).count()
