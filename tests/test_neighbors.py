"""Neighbour joins against NumPy: odd shapes, duplicates, pruning, long chains."""

import numpy as np
import pandas as pd
import pytest

from netsift.operators.detectors import DBSCAN
from netsift.operators.detectors.neighbors import Balls, RangeIndex, _distances, _join_cells, knn, pairs_visited


def _frame(spark, x):
    x = np.asarray(x, float)
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x": list(x)})).repartition(3)


def _brute(x, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), d[i]))[:k]] for i in range(len(x))}


RNG = np.random.default_rng(1)
SHAPES = {
    "line": RNG.normal(size=(100, 1)),
    "collinear": RNG.normal(size=(120, 1)) * np.array([[1.0, 2.0, -3.0]]),
    "far_outlier": np.vstack([RNG.normal(size=(150, 4)), [[1e6, 0, 0, 0]]]),
    "duplicates": np.vstack([np.zeros((70, 3)), RNG.normal(size=(80, 3)), np.ones((40, 3))]),
    "few": RNG.normal(size=(3, 2)),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_knn_exact(spark, shape):
    x = np.round(SHAPES[shape], 3)
    df = _frame(spark, x)
    got = {r.qid: [e.id for e in r.nbrs] for r in knn(df, df, 5, block=16).collect()}
    assert got == _brute(x, 5)


def test_knn_without_data(spark):
    df = _frame(spark, SHAPES["few"])
    assert [r.nbrs for r in knn(df, df.limit(0), 2).collect()] == [[], [], []]


@pytest.mark.parametrize("clusters", [20, 60])
def test_clustered_data_visit_few_pairs(spark, clusters):
    """At two sizes: a query row is sent to few cells, and a cell is met by few queries."""
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(clusters, 1, 6)) * 100 + rng.normal(size=(clusters, 100, 6))).reshape(-1, 6)
    ix = RangeIndex(_frame(spark, x), 3.0, block=50)
    sent, pairs = pairs_visited(ix.points.select("x"), ix.pivots, 3.0)
    assert sent < 5 * len(x) and pairs < 4 * len(x) ** 2 / clusters


def test_groups_are_bounded(spark):
    """A cell of many rows and many queries is split, and every pair still meets once."""
    x = np.round(RNG.normal(size=(700, 2)), 3)
    ix = RangeIndex(_frame(spark, x), 0.5, block=10 ** 6)  # one cell
    sizes = "nq long, nd long"
    body = lambda q, c: pd.DataFrame({"nq": [len(q)], "nd": [len(c)]})
    p = ix.points.select("id", "x", "cell")
    got = _join_cells(p, p, ix.pivots, body, sizes, cell_rows=100, query_rows=150, reach=0.5).collect()
    assert max(r.nq for r in got) < 250 and max(r.nd for r in got) < 180
    assert sum(r.nq * r.nd for r in got) == len(np.unique(x, axis=0)) ** 2


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_balls_against_all_pairs(shape):
    x = np.round(SHAPES[shape], 3)
    q = np.vstack([x[::3], x[:5] + 0.25])
    d, ids = _distances(q, x), np.arange(len(x))[::-1].copy()
    balls = Balls(x, leaf=8)
    assert sorted(np.concatenate(balls.rows).tolist()) == list(range(len(x)))
    dist, near = balls.nearest(q, 4, ids, np.full(len(q), np.inf))
    for i, row in enumerate(d):
        best = np.lexsort((ids, row))[:4]
        assert near[i][:len(best)].tolist() == ids[best].tolist() and np.array_equal(dist[i][:len(best)], row[best])
    for eps in (0.0, 0.3, 1.0):
        held = np.zeros(d.shape, bool)
        for r, whole, some, hit in balls.within(q, eps):
            held[np.ix_(whole, r)] = True
            held[np.ix_(some, r)] = hit
        assert np.array_equal(held, d <= eps)


def test_dense_balls_are_taken_without_distances():
    x = np.vstack([RNG.normal(size=(5000, 3)) * 1e-3, RNG.normal(size=(200, 3)) * 50])
    balls = Balls(x)
    measured = sum(hit.size for _, _, _, hit in balls.within(x, 1.0))
    assert measured < 0.1 * len(x) ** 2  # some balls hold outliers beside a few dense rows


def test_dbscan_follows_a_long_chain(spark):
    x = np.arange(400.0)[:, None] * np.array([[0.6, 0.8]])
    x = np.vstack([x, [[5000.0, 0.0]]])
    df = _frame(spark, x).withColumnRenamed("x", "features")
    got = {r.id: r.cluster for r in DBSCAN(eps=1.01, min_samples=2).fit_predict(df).collect()}
    assert {got[i] for i in range(400)} == {0} and got[400] == -1


def test_dbscan_counts_duplicates(spark):
    x = np.vstack([np.zeros((10, 2)), [[0.5, 0.0]], [[9.0, 9.0]]])
    df = _frame(spark, x).withColumnRenamed("x", "features")
    got = {r.id: (r.degree, r.is_core, r.cluster) for r in DBSCAN(eps=1.0, min_samples=11).fit_predict(df).collect()}
    assert all(got[i] == (11, 1, 0) for i in range(11)) and got[11] == (1, 0, -1)


def test_neighbour_descent_reaches_its_recall(spark):
    from netsift.operators.detectors.descent import descent_knn, recall
    rng = np.random.default_rng(6)
    x = _frame(spark, rng.normal(size=(600, 16)))  # isotropic: bounds exclude nothing
    got = descent_knn(x, 8, block=60)
    rows = {r.qid: r.nbrs for r in got.collect()}
    assert len(rows) == 600 and all(n[0].id == q and n[0].dist == 0 and len(n) == 8 and len({e.id for e in n}) == 8 for q, n in rows.items())
    assert recall(got, x, x.where("id % 3 = 0"), 8) > 0.9
    # a hub: one vector held by a third of all rows
    hub = _frame(spark, np.vstack([np.zeros((100, 3)), rng.normal(size=(200, 3))]))
    near = descent_knn(hub, 5, block=40, sample=12)
    assert near.count() == 300 and recall(near, hub, hub.where("id >= 100"), 5) > 0.85
    assert descent_knn(x.limit(0), 5).collect() == []
    one = descent_knn(x.where("id = 3"), 5).collect()
    assert [(r.qid, [e.id for e in r.nbrs]) for r in one] == [(3, [3])]


def test_queries_leave_python_in_bounded_frames():
    """A query that needs every one of many cells: the frames of a batch do not grow with the cells."""
    from netsift.operators.detectors import neighbors as N
    x = RNG.normal(size=(3000, 8))
    pivots = N.Pivots(RNG.normal(size=(4000, 8)))
    pivots.count[:] = 1
    parts = list(N._hits(pivots, reach=100.0)([pd.DataFrame({"id": np.arange(3000), "x": list(x)})]))
    assert sum(len(p) for p, _ in parts) == 3000 and all(hit.all() for _, hit in parts)
    assert max(hit.size for _, hit in parts) <= N._CHUNK


def test_where_bounds_exclude_nothing_a_query_is_sent_once_a_bin(spark):
    """Isotropic rows in 40 cells: all pairs meet once, and no query is copied to each cell."""
    x = RNG.normal(size=(2000, 16))
    ix = RangeIndex(_frame(spark, x), 50.0, block=50)
    body = lambda q, c: pd.DataFrame({"nq": [len(q)], "nd": [len(c)]})
    p = ix.points.select("id", "x", "cell")
    got = _join_cells(p, p, ix.pivots, body, "nq long, nd long", cell_rows=1000, reach=50.0).collect()
    assert sum(r.nq * r.nd for r in got) == 2000 ** 2 and sum(r.nq for r in got) <= 4 * 2000
    assert max(r.nd for r in got) < 1100


def test_squares_bound_the_distances():
    """Far offsets, an outlier and a row that is not finite: bounds hold, and settle what they can."""
    from netsift.operators.detectors.neighbors import Squares
    x = RNG.normal(size=(60, 5)) + 1e5
    x[3] = 1e9
    d = _distances(x, x) ** 2
    least, most = Squares(x).bounds(x)
    assert (least <= d).all() and (d <= most).all()
    near, far = Squares(x[4:]).bounds(x[4:])
    assert (far - near).max() < 1e-6 * d[4:, 4:].max()
    x[7] = np.nan
    least, most = Squares(x).bounds(x)
    keep = np.arange(60) != 7
    assert np.isnan(least[7]).all() and (least <= _distances(x, x) ** 2)[np.ix_(keep, keep)].all()


def test_local_joins_send_only_possible_links(spark):
    from netsift.operators.detectors import descent
    x = _frame(spark, RNG.normal(size=(300, 16)))
    rows = x.selectExpr("cast(id as long) id", "x")
    edges = descent._nearest_links(descent._first_graph(rows, 10, 50), 10).cache()
    far = {r.a: r.d for r in edges.groupBy("a").agg({"d": "max"}).toDF("a", "d").collect()}
    met = descent._local_joins(edges, rows, 10, 20, 0).collect()
    assert met and all(r.d <= far[r.a] for r in met)
    assert edges.groupBy("a", "b").count().where("count > 1").isEmpty() and edges.groupBy("a").count().where("count <> 10").isEmpty()


def test_rows_of_one_id_keep_their_number(spark):
    """A data row that comes twice is met twice, however the cells are joined to bins."""
    x = RNG.normal(size=(120, 12))
    x = np.vstack([x, x[:40]])
    ids = np.concatenate([np.arange(120), np.arange(40)])
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "x": list(x)}))
    d = _distances(x, x)
    want = {int(ids[i]): [int(ids[j]) for j in np.lexsort((ids, d[i]))[:6]] for i in range(160)}
    got = knn(df, df, 6, block=8).collect()
    assert len(got) == 160 and all([e.id for e in r.nbrs] == want[r.qid] for r in got)


def test_single_precision_settles_most_pairs_and_no_wrong_one():
    """bounds around the queries hold at far places, beside outliers, below and above the range of a float."""
    from netsift.operators.detectors.neighbors import Near
    base = RNG.normal(size=(80, 6))
    for x in (base + 1e7, base * 1e-25, base * 1e22, np.vstack([base, [[1e9] * 6], [[np.nan] * 6], [[1e200] * 6]])):
        d = _distances(x, x) ** 2
        least, of_q, of_x = Near(x).least(x)
        known = np.isfinite(least)
        assert (least[known] <= d[known] + 1e-30).all() and (least + of_q[:, None] + of_x >= d - 1e-30)[known].all()
    held = Near(base + 1e7).least(base + 1e7)
    assert (held[1].max() + held[2].max()) < 0.01  # the place far out costs no precision
    eps = float(np.sqrt(np.median(_distances(base, base) ** 2)))
    for x in (base, base * 1e-25, np.vstack([base, base[:9] + 1e-9]), np.vstack([base, [[np.nan] * 6]])):
        e, got = eps * (1e-25 if np.abs(x[0]).max() < 1e-20 else 1), np.zeros((len(x), len(x)), bool)
        for r, whole, some, hit in Balls(x[:80], leaf=8).within(x, e):
            got[np.ix_(whole, r)] = True
            got[np.ix_(some, r)] = hit
        assert np.array_equal(got[:, :80], _distances(x, x[:80]) <= e)


def test_second_pass_grows_one_tree_a_task(spark):
    """rows of the first pass are met again, not cut out of the bin by a tree for each cell of its queries;
    a task sends back one row a query."""
    from netsift.operators.detectors import neighbors as N
    assert N._top.__code__.co_varnames[:N._top.__code__.co_argcount] == ("k",)
    x = RNG.normal(size=(900, 12))
    ix = RangeIndex(_frame(spark, x), 1.0, block=30)
    p = ix.points.select("id", "x", "cell")
    got = _join_cells(p, p, ix.pivots, N._top(5), N.NEAREST, cell_rows=300, arrow=True, reach=100.0)
    assert got.where("size(nbrs) > 5").isEmpty() and got.groupBy("qid").count().agg({"count": "max"}).first()[0] <= 6
    best = {r.qid: [e.id for e in r.nbrs] for r in N._merged(got, 5, True).collect()}
    assert best == _brute(x, 5) == {r.qid: [e.id for e in r.nbrs] for r in N._merged(got, 5, False).collect()}


def test_degrees_meet_two_bins_once(spark, monkeypatch):
    """with weights, in parts and bins, each pair of bins is met in one direction and counts on both sides."""
    from netsift.operators.detectors import neighbors as N
    monkeypatch.setattr(N, "CELL_ROWS", 150)
    monkeypatch.setattr(N, "SENT", 1)
    x = np.round(RNG.normal(size=(700, 2)), 1)
    x = np.vstack([x, x[:50], x[:20], RNG.normal(size=(300, 2)) * 0.001])
    ix = RangeIndex(_frame(spark, x), 0.7, block=60)
    got = {r.id: r.degree for r in ix.degrees().collect()}
    d = _distances(x, x) <= 0.7
    first = {tuple(v): i for i, v in reversed(list(enumerate(x)))}
    assert got == {i: int(d[i].sum()) for i in first.values()}
    body = lambda q, c: pd.DataFrame({"nq": [len(q)], "nd": [len(c)]})
    p = ix.points.select("id", "x", "cell")
    pairs = lambda **how: sum(r.nq * r.nd for r in _join_cells(p, p, ix.pivots, body, "nq long, nd long", reach=50.0, **how).collect())
    assert pairs(half=True) < 0.75 * pairs()


def test_links_join_what_is_apart_only(spark):
    """clusters inside cells, across cells and in a chain through all of them; joined labels send no query."""
    x = np.vstack([np.arange(300.0)[:, None] * [[0.5, 0.0]], RNG.normal(size=(200, 2)) * 0.2 + [[0.0, 50.0]], [[900.0, 900.0]]])
    ix = RangeIndex(_frame(spark, x), 0.6, block=20)
    core = spark.createDataFrame([(i, 0 if i < 300 else 300) for i in range(500)], "id long, label long")
    assert ix.links(core).collect() == []
    p = ix.points.join(core, "id").select("id", "x", "label", "cell")
    from netsift.operators.detectors.neighbors import _asked
    need = {"reach": 0.6, "labels": ix._labels_of_cells(p)}
    bins = [np.arange(len(ix.pivots.points))]
    one = p.withColumn("label", p["cell"].cast("long") * 0)
    assert _asked(one, ix.pivots, bins, reach=0.6, labels=ix._labels_of_cells(one))[0].sum() == 0
    assert _asked(p, ix.pivots, bins, **need)[0].sum() <= 2 * 500
    df = _frame(spark, x).withColumnRenamed("x", "features")
    got = {r.id: r.cluster for r in DBSCAN(eps=0.6, min_samples=2).fit_predict(df).collect()}
    assert {got[i] for i in range(300)} == {0} and {got[i] for i in range(300, 500)} == {300} and got[500] == -1


def test_least_label_asks_cells_with_core_rows_only(spark):
    """where no row is core, no query is sent."""
    x = RNG.normal(size=(200, 3))
    ix = RangeIndex(_frame(spark, x), 0.5, block=20)
    none = spark.createDataFrame([], "id long, label long")
    from netsift.operators.detectors.neighbors import _asked
    empty = ix._labels_of_cells(ix.points.join(none, "id").select("id", "x", "label", "cell"))
    assert _asked(ix.points.select("id", "x", "cell"), ix.pivots, [np.arange(len(ix.pivots.points))], reach=0.5, labels=empty)[0].sum() == 0
    assert ix.least_label(ix.points.select("id"), none).collect() == []
