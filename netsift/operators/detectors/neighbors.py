"""Exact neighbour joins by pivot cells, the triangle inequality and balls inside a cell.

Rows are dealt to the nearest of about n / block pivots (data rows chosen by a hash, at most
``MAX_PIVOTS``; only pivots, radii and counts reach the driver). A cell with pivot p and
radius R holds nothing within t of a query q when d(q, p) - R > t, so a query is sent, as one
row, to the cells that may hold a row it needs and to no other. Where the bounds exclude little,
a query would be sent to nearly every cell; cells near one another are then joined to bins of up
to ``part_rows`` rows, as far as the rows sent less outweigh the pairs met more, and a query is sent once a bin.
Data rows are sent once for every ``part_rows`` queries of their bin; a cell of more rows is split
by a hash and its queries go to each part, so no group grows with the data: ``part_rows`` is an
eighth of the data, at least ``CELL_ROWS`` and at most ``MOST_ROWS``, since all pairs of n rows copy
each row n / ``part_rows`` times. Rows leave Python in frames of bounded size, however many cells a
query needs.

*Inside a task* the data rows are cut into balls of about ``LEAF`` rows (splits along the widest
axis), and queries near one another visit them together. Squared distances come from a matrix
product in single precision, around the middle of the queries, with a bound of its rounding, which
settles nearly all pairs; the others, and all distances returned, are computed from the differences:

* **k nearest neighbours** take balls in order of their distance, and those beyond the running
  k-th distance not at all. They take two passes over cells: the first visits the nearest cells
  that hold k rows and so bounds the k-th distance; the second visits the cells that the bound
  does not exclude.
* **ranges** (DBSCAN) skip balls beyond eps, and take a ball that lies wholly within eps
  without a distance, so the work in a dense cell is linear in its queries and balls. A task
  sends back degree sums, spanning links or least labels, never pairs. Links are looked for between
  rows of different labels only. Two bins meet once: what one holds of the other is counted on both sides.

Bounds work in all dimensions, on collinear data and with far outliers; where distances are
nearly equal (isotropic data of many dimensions) they exclude little, as in any exact method.
Equal vectors are one query, and at most k of them (the smallest ids) are data of a kNN
search; in range searches they are one point with a weight.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..joins import materialize

CELL_BLOCK = 1024   # rows of a cell, on average, as long as there are at most MAX_PIVOTS cells
MAX_PIVOTS = 4096
CELL_ROWS = 16_384  # rows of a cell, or queries of it, in one task, as long as there are few
MOST_ROWS = 65_536  # and at most
LEAF = 64
MIDDLE_SPLITS = 24
QUERY_STEP = 1024   # queries of a task that visit balls together
STEP_ROWS = 1024    # rows of the balls that they visit at once
SENT = 4000         # pairs that take as long as sending a row to a task
MOST_PARTITIONS = 512
_CHUNK = 4_000_000  # doubles per distance chunk inside a task
_SLACK = 1e-9       # rounding of a distance, relative: bounds give way by it
_TINY = 1e-30       # what single precision may lose of a square below its range
_HUGE = 1e36        # squares that single precision does not hold safely
GROUP = ["dcell", "dsalt", "qsalt"]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    step = max(1, _CHUNK // max(1, b.size))
    for s in range(0, len(a), step):
        diff = a[s:s + step, None, :] - b[None, :, :]
        out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _pair_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs ``a[i]``, ``b[j]``."""
    out = np.empty(len(i))
    step = max(1, _CHUNK // max(1, a.shape[1]))
    for s in range(0, len(i), step):
        diff = (a[i[s:s + step]] - b[j[s:s + step]])[:, None, :]
        out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))[:, 0]
    return out


class Squares:
    """Bounds of the squared distances to the rows of ``x``, from one matrix product."""

    def __init__(self, x: np.ndarray):
        whole = x[np.isfinite(x).all(axis=1)]
        self.mid = whole.mean(axis=0) if len(whole) else np.zeros(x.shape[1])
        self.x = x - self.mid
        self.norm = np.einsum("ij,ij->i", self.x, self.x)
        self.unit = 4 * (x.shape[1] + 8) * np.finfo(float).eps  # rounding of the sums, relative to the norms

    def bounds(self, q: np.ndarray, rows=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) squared distance of each row of ``q`` to each of ``rows``."""
        q = q - self.mid
        norms = np.einsum("ij,ij->i", q, q)[:, None] + self.norm[rows]
        square = norms - 2.0 * (q @ self.x[rows].T)
        norms *= self.unit
        return square - norms, square + norms

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) distance of each row of ``q`` to each row."""
        least, most = self.bounds(q)
        return np.sqrt(np.maximum(least, 0)), np.sqrt(np.maximum(most, 0))


class Near:
    """Least squared distances from queries near one another, in single precision: both sides are taken around
    the middle of the queries, so that the rounding goes with their distances and not with their place."""

    def __init__(self, q: np.ndarray):
        whole = q[np.isfinite(q).all(axis=1)]
        self.mid = np.median(whole, axis=0) if len(whole) else np.zeros(q.shape[1])
        self.unit = 4 * (q.shape[1] + 8) * float(np.finfo(np.float32).eps)  # rounding of the sums, relative to the norms
        z, self.norm = self._around(q)
        self.q = np.column_stack([-2.0 * z, self.norm * (1 - self.unit), np.ones(len(q))]).astype(np.float32)

    def _around(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore", invalid="ignore"):
            z = x - self.mid
            norm = np.einsum("ij,ij->i", z, z)
            far = ~(norm < _HUGE)
            z[far], norm[far] = 0.0, np.nan  # nothing is known: such rows are measured
        return z, norm

    def least(self, x: np.ndarray, rows=slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least squared distance of each of ``rows`` of the queries to each row of ``x``, and what the largest
        exceeds it by at most: a share of the query and one of the row."""
        z, norm = self._around(x)
        x32 = np.column_stack([z, np.ones(len(x)), norm * (1 - self.unit)]).astype(np.float32)
        return self.q[rows] @ x32.T, 2 * self.unit * self.norm[rows], 2 * self.unit * norm


def _above(limit: np.ndarray | float) -> np.ndarray:
    """A single-precision limit above which a least square is larger than ``limit``."""
    with np.errstate(over="ignore"):
        return np.nextafter(np.asarray(np.asarray(limit) * (1 + _SLACK) + _TINY, np.float32), np.float32(np.inf))


def _matrix(col) -> np.ndarray:
    return np.array(col.tolist(), dtype=float)


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    """The columns of a task's rows; vectors as one matrix."""
    out = {}
    for name in table.column_names:
        col = table.column(name).combine_chunks()
        if not pa.types.is_list(col.type):
            out[name] = col.to_numpy(zero_copy_only=False)
            continue
        widths = np.unique(np.diff(col.offsets.to_numpy()))
        if col.null_count or len(widths) > 1:
            raise ValueError("vectors must have one length")
        out[name] = col.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(col), widths[0] if len(widths) else 1)
    return out


def _frames(pdf: pd.DataFrame, width: int):
    """``pdf`` in parts whose rows times ``width`` stay bounded."""
    step = max(1, _CHUNK // max(1, width))
    for s in range(0, len(pdf), step):
        yield pdf.iloc[s:s + step]


class Pivots:
    """Pivot vectors with the radius and the number of rows of each cell."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.radius = np.zeros(len(points))
        self.count = np.zeros(len(points), np.int64)

    @classmethod
    def choose(cls, data: DataFrame, n: int, block: int, seed: int = 7) -> "Pivots":
        m = min(MAX_PIVOTS, max(1, -(-n // block)))
        rows = data.select("x").orderBy(F.xxhash64(F.lit(seed), "x")).limit(m).toPandas()
        return cls(np.unique(_matrix(rows["x"]), axis=0) if len(rows) else np.zeros((0, 1)))

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``cell`` (nearest pivot) and ``away`` (distance to it)."""
        points, cols = self.points, df.columns

        def go(batches):
            squares = Squares(points)
            for batch in batches:
                for pdf in _frames(batch, len(points)):
                    x = _matrix(pdf["x"])
                    cell = squares.bounds(x)[0].argmin(axis=1)
                    yield pdf[cols].assign(cell=cell.astype("int32"), away=_pair_distances(x, points, np.arange(len(x)), cell))

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return materialize(df.mapInPandas(go, f"{fields}, cell int, away double"))

    def measure(self, cells: DataFrame) -> None:
        """Take radius and number of rows of each cell from the assigned data."""
        sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).toPandas()
        self.count[sizes["cell"]], self.radius[sizes["cell"]] = sizes["n"], sizes["r"]

    def hits(self, x: np.ndarray, reach) -> np.ndarray:
        """Which cells may hold a row within ``reach`` of each row of ``x``."""
        d, _ = Squares(self.points).distances(x)
        return (d - self.radius <= reach + _SLACK * (1 + d)) & (self.count > 0)

    def levels(self, most: int) -> list[np.ndarray]:
        """The bin of each cell, in several ways: bins of cells near one another with up to ``most`` rows, with
        a quarter of that, and one cell a bin."""
        order = np.concatenate(Balls(self.points, leaf=1).rows)
        out = []
        for rows in (most, most // 4):
            bins, held, at = np.zeros(len(order), np.int64), 0, 0
            for c in order:
                if held and held + self.count[c] > rows:
                    held, at = 0, at + 1
                bins[c] = at
                held += self.count[c]
            out.append(bins)
        return [*out, np.arange(len(order))]


def _binned(hit: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Which bins hold a cell that is hit, for each row of ``hit``."""
    order = np.argsort(bins, kind="stable")
    return np.logical_or.reduceat(hit[:, order], np.flatnonzero(np.diff(bins[order], prepend=-1)), axis=1)


def _hits(pivots: Pivots, reach: str | float = 0.0, seeds: list[list[int]] | None = None,
          labels: tuple[np.ndarray, np.ndarray] | None = None):
    """A function from batches of queries to (queries, which cells they need) in parts of bounded size: the cells
    that may hold a row within ``reach``, or the ``seeds`` of the query's own cell. With ``labels``, the least and
    the largest label of each cell, a cell without any is not needed, nor one of a labelled query's label only."""
    def go(batches):
        for batch in batches:
            for pdf in _frames(batch, len(pivots.points)):
                if seeds is not None:
                    hit = np.zeros((len(pdf), len(pivots.points)), bool)
                    for r, c in enumerate(pdf["cell"]):
                        hit[r, seeds[c]] = True
                else:
                    hit = pivots.hits(_matrix(pdf["x"]), pdf[reach].to_numpy(float)[:, None] if isinstance(reach, str) else reach)
                if labels is not None:
                    low, high = labels
                    hit &= low <= high
                    if "label" in pdf:
                        own = pdf["label"].to_numpy(np.int64)[:, None]
                        hit &= ~((low == own) & (high == own))
                yield pdf, hit
    return go


def _bins_needed(pdf: pd.DataFrame, hit: np.ndarray, bins: np.ndarray, half: bool) -> np.ndarray:
    """Which bins each query needs; ``half``: of two bins that need each other, the later one only."""
    need = _binned(hit, bins)
    return need & (np.arange(need.shape[1]) >= bins[pdf["cell"].to_numpy()][:, None]) if half else need


def _needed(queries: DataFrame, pivots: Pivots, bins: np.ndarray, half: bool = False, **need) -> DataFrame:
    """``queries`` with ``dcell``, a row per bin of cells that a query needs."""
    cols, hits = queries.columns, _hits(pivots, **need)

    def go(batches):
        for pdf, hit in hits(batches):
            i, j = np.nonzero(_bins_needed(pdf, hit, bins, half))
            yield pdf[cols].assign(dcell=np.split(j.astype("int32"), np.searchsorted(i, np.arange(1, len(pdf)))))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    # the JVM copies the rows
    return queries.mapInPandas(go, f"{fields}, dcell array<int>").withColumn("dcell", F.explode("dcell"))


def _asked(queries: DataFrame, pivots: Pivots, levels: list[np.ndarray], half: bool = False, **need) -> list[np.ndarray]:
    """For each level, how many queries need each of its bins."""
    hits = _hits(pivots, **need)

    def go(batches):
        sums = [np.zeros(bins.max() + 1, np.int64) for bins in levels]
        for pdf, hit in hits(batches):
            for n, bins in zip(sums, levels):
                n += _bins_needed(pdf, hit, bins, half).sum(axis=0)
        for level, n in enumerate(sums):
            at = np.flatnonzero(n)
            yield pd.DataFrame({"level": np.full(len(at), level, "int32"), "dcell": at.astype("int32"), "n": n[at]})

    got = queries.mapInPandas(go, "level int, dcell int, n long").groupBy("level", "dcell").agg(F.sum("n").alias("n"))
    out = [np.zeros(bins.max() + 1, np.int64) for bins in levels]
    for level, part in got.toPandas().groupby("level"):  # at most MAX_PIVOTS rows a level
        out[level][part["dcell"]] = part["n"]
    return out


def pairs_visited(queries: DataFrame, pivots: Pivots, reach: str | float) -> tuple[int, int]:
    """Query rows sent to cells, and pairs of a query and a row of such a cell (for tests and tuning)."""
    n = _asked(queries, pivots, [np.arange(len(pivots.points))], reach=reach)[0]
    return int(n.sum()), int((n * pivots.count).sum())


def _join_cells(queries: DataFrame, cells: DataFrame, pivots: Pivots, body: Callable, schema: str, cell_rows: int | None = None,
                query_rows: int | None = None, arrow: bool = False, **need) -> DataFrame:
    """Run ``body(queries, data)`` for every bin of cells and the queries that need it. A bin may hold cells that a
    query of it does not need. ``arrow``: the body takes and returns Arrow tables, else pandas frames."""
    part_rows = min(MOST_ROWS, max(CELL_ROWS, -(-int(pivots.count.sum()) // 8)))
    cell_rows, query_rows = cell_rows or part_rows, query_rows or part_rows
    levels = pivots.levels(cell_rows)
    asked = _asked(queries, pivots, levels, **need)
    count = [np.bincount(bins, weights=pivots.count).astype(np.int64) for bins in levels]
    most = lambda rows, size: -(-rows // size)
    cost = [(a * c).sum() + SENT * (a * most(c, cell_rows) + c * most(a, query_rows)).sum() for a, c in zip(asked, count)]
    best = int(np.argmin(cost))
    bins, asked, count = levels[best], asked[best], count[best]

    def parts(rows: np.ndarray, size: int) -> Column:
        return F.get(F.array(*(F.lit(int(c)) for c in most(rows, size))), F.col("dcell"))

    n_d, n_q = parts(count, cell_rows), parts(asked, query_rows)
    part = lambda k, seed: F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), k).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    left = _needed(queries, pivots, bins, **need).withColumn("qsalt", part(n_q, 5)).withColumn("dsalt", every(n_d))
    bin_of = F.get(F.array(*(F.lit(int(b)) for b in bins)), F.col("cell"))
    if need.get("half"):  # where the bin's rows do not come as queries to the query's own
        left = left.withColumn("other", F.col("dcell") != bin_of)
    data = cells.withColumn("dcell", bin_of).where(n_q > 0)
    right = data.withColumn("dsalt", part(n_d, 3)).withColumn("qsalt", every(n_q))
    # where groups are few and large, in more partitions than groups, few of which hold two
    groups = int((most(count, cell_rows) * most(asked, query_rows)).sum())
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = n if groups > 8 * n else max(n, min(MOST_PARTITIONS, 4 * groups))
    # columns under new ids: both sides may come from one table
    fresh = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns)).repartition(n, *GROUP)
    both = fresh(left).groupBy(*GROUP).cogroup(fresh(right).groupBy(*GROUP))
    return both.applyInArrow(body, schema) if arrow else both.applyInPandas(body, schema)


def _leaves(x: np.ndarray, leaf: int) -> list[np.ndarray]:
    """The rows of ``x`` in parts of about ``leaf`` rows near one another; parts that follow are near, too."""
    whole = np.isfinite(x).all(axis=1)
    odd = np.flatnonzero(~whole)  # near nothing
    todo, rows = [(np.flatnonzero(whole), 0)] if whole.any() else [], [odd[s:s + leaf] for s in range(0, len(odd), leaf)]
    while todo:
        r, depth = todo.pop()
        v = x[r]
        lo, hi = v.min(axis=0), v.max(axis=0)
        axis = int((hi - lo).argmax())
        if len(r) <= leaf or hi[axis] == lo[axis]:
            rows.append(r)
            continue
        v = v[:, axis]
        if depth < MIDDLE_SPLITS:  # in the middle of the range: dense parts and outliers part early
            left = v <= (lo[axis] + hi[axis]) / 2
            left = left if not left.all() else v < hi[axis]  # the middle of neighbouring numbers is the upper one
        else:                      # at the median
            left = np.zeros(len(r), bool)
            left[np.argsort(v, kind="stable")[:len(r) // 2]] = True
        todo += [(r[left], depth + 1), (r[~left], depth + 1)]
    return rows


def _blocks(q: np.ndarray) -> list[np.ndarray]:
    """The queries of a task in steps of ``QUERY_STEP`` near one another."""
    order = np.concatenate(_leaves(q, LEAF)) if len(q) else np.zeros(0, int)
    return [order[s:s + QUERY_STEP] for s in range(0, len(order), QUERY_STEP)]


def _counts(hit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``hit @ weight``, most weights being 1."""
    n = np.bitwise_count(np.packbits(hit, axis=1)).sum(axis=1, dtype=np.int64)
    heavy = np.flatnonzero(weight != 1)
    return n + (hit[:, heavy] @ (weight[heavy] - 1).astype(float)).astype(np.int64) if len(heavy) else n


def _column_counts(hit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``weight @ hit``, most weights being 1."""
    n = np.zeros(hit.shape[1], np.int64)
    for s in range(0, len(hit), 255):  # sums of bytes that do not overflow
        n += hit[s:s + 255].view(np.uint8).sum(axis=0, dtype=np.uint8)
    heavy = np.flatnonzero(weight != 1)
    return n + ((weight[heavy] - 1).astype(float) @ hit[heavy]).astype(np.int64) if len(heavy) else n


class Balls:
    """The rows of a task, cut into balls: centre, radius and the rows of each."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.rows = x, _leaves(x, leaf)
        self.size = np.array([len(r) for r in self.rows])
        self.centre = np.array([x[r].mean(axis=0) for r in self.rows])
        self.radius = np.array([_distances(x[r], c[None, :]).max() for r, c in zip(self.rows, self.centre)])
        self.radius *= 1 + _SLACK
        self.centres = Squares(self.centre)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the distances to each ball's rows: none is nearer, none is farther."""
        least, most = self.centres.distances(q)
        return np.maximum(least - self.radius - _SLACK * (1 + least), 0), (most + self.radius) * (1 + _SLACK)

    def _steps(self, order: np.ndarray):
        """Balls in the given order, as many at once as hold ``STEP_ROWS`` rows."""
        ends, s = np.cumsum(self.size[order]), 0
        while s < len(order):
            e = int(np.searchsorted(ends, (ends[s - 1] if s else 0) + STEP_ROWS)) + 1
            yield order[s:e]
            s = e

    def _rows(self, balls: np.ndarray) -> np.ndarray:
        return np.concatenate([self.rows[b] for b in balls])

    def nearest(self, q: np.ndarray, k: int, ids: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the k nearest rows within ``reach`` of each query, ties by id (inf: none)."""
        dist, near = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        for at in _blocks(q):
            dist[at], near[at] = self._nearest(q[at], k, ids, reach[at].astype(float))
        return dist, near

    def _nearest(self, q: np.ndarray, k: int, ids: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dist, near = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        low, _ = self.bounds(q)
        bound, first, single = reach.copy(), np.fmin.reduce(low, axis=0), Near(q)
        met, n_met = [], 0  # pairs since the last merge

        def merge():
            i, d, n = (np.concatenate(part) for part in zip(*met))
            held = np.unique(i)  # the queries that met a row: their k nearest so far, and the rows met
            i = np.concatenate([np.repeat(held, k), i])
            d, n = np.concatenate([dist[held].ravel(), d]), np.concatenate([near[held].ravel(), n])
            by = np.lexsort((n, d, i))
            ends = np.searchsorted(i[by], held)[:, None] + np.arange(k)
            dist[held], near[held] = d[by[ends]], n[by[ends]]
            bound[held] = np.minimum(bound[held], dist[held, -1])
            met.clear()

        for step in self._steps(np.argsort(first, kind="stable")):
            if first[step[0]] > bound.max():
                break
            want = low[:, step] <= bound[:, None]
            step, open_ = step[want.any(axis=0)], np.flatnonzero(want.any(axis=1))
            if not len(open_):
                continue
            r = self._rows(step)
            least, of_q, of_x = single.least(self.x[r], open_)
            limit, unbound = bound[open_] ** 2, np.isinf(bound[open_])
            if len(r) > k and unbound.any():  # no k rows yet: the k-th of these is a bound
                most = least[unbound] + of_q[unbound, None] + of_x
                limit[unbound] = np.fmin(limit[unbound], np.partition(most, k - 1, axis=1)[:, k - 1])
            i, j = np.divmod(np.flatnonzero(~(least > _above(limit)[:, None])), len(r))
            if not len(i):
                continue
            i = open_[i]
            d = _pair_distances(q, self.x, i, r[j])
            in_reach = np.flatnonzero(d <= reach[i])
            met.append((i[in_reach], d[in_reach], ids[r[j[in_reach]]]))
            n_met += len(in_reach)
            if n_met > k * len(q) or unbound.any():
                merge()
                n_met = 0
        if met:
            merge()
        return dist, near

    def within(self, q: np.ndarray, eps: float, apart: Callable | None = None):
        """(rows, queries that hold all of them within eps, queries that hold some, and which): together all pairs
        within eps. ``apart`` may leave out queries and rows whose pairs are not asked for."""
        none = np.zeros(0, int)
        for at in _blocks(q):
            low, high = self.bounds(q[at])
            want, whole = low <= eps, high <= eps
            open_ = (want & ~whole).any(axis=0)
            every = whole.all(axis=0)
            if every.any():
                r = self._rows(np.flatnonzero(every))
                yield r, at, none, np.zeros((0, len(r)), bool)
            for b in np.flatnonzero(whole.any(axis=0) & ~open_ & ~every):
                yield self.rows[b], at[whole[:, b]], none, np.zeros((0, len(self.rows[b])), bool)
            single = None
            for step in self._steps(np.flatnonzero(open_)):
                part, r = np.flatnonzero((want | whole)[:, step].any(axis=1)), self._rows(step)
                if apart:
                    few, r = apart(at[part], r)
                    part = part[few]
                    if not len(part) or not len(r):
                        continue
                single = single or Near(q[at])
                yield r, none, at[part], self._hit(q, at[part], single.least(self.x[r], part), r, eps)

    def _hit(self, q: np.ndarray, at: np.ndarray, bounds: tuple, r: np.ndarray, eps: float) -> np.ndarray:
        """Which of the rows ``r`` each query holds within eps."""
        least, of_q, of_x = bounds
        hit = ~(least > _above(eps * eps))
        sure = eps * eps * (1 - _SLACK) - _TINY
        if np.count_nonzero(hit) * 10 < hit.size:
            f = np.flatnonzero(hit)
            i, j = np.divmod(f, len(r))
            open_ = ~(least.ravel()[f] + of_q[i] + of_x[j] <= sure)
            f, i, j = f[open_], i[open_], j[open_]
        else:
            f = np.flatnonzero(hit & ~((least + of_x) <= (sure - of_q)[:, None]))
            i, j = np.divmod(f, len(r))
        if len(f):
            hit.ravel()[f] = _pair_distances(q, self.x, at[i], r[j]) <= eps
        return hit


NEAREST = "qid long, nbrs array<struct<dist:double,id:bigint>>"


def _top(k: int):
    """The ``k`` nearest rows of each query, as one row a query."""
    def body(q: pa.Table, c: pa.Table) -> pa.Table:
        q, c = _columns(q), _columns(c)
        qid, ids = q["id"].astype(np.int64), c["id"].astype(np.int64)
        n, d, near = np.zeros(len(qid), np.int64), np.zeros(0), np.zeros(0, np.int64)
        if len(qid) and len(ids):
            reach = q["reach"].astype(float) if "reach" in q else np.full(len(qid), np.inf)
            dist, near = Balls(c["x"]).nearest(q["x"], k, ids, reach)
            held = np.isfinite(dist)
            n, d, near = held.sum(axis=1), dist[held], near[held]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                         pa.StructArray.from_arrays([pa.array(d), pa.array(near)], ["dist", "id"]))
        return pa.Table.from_arrays([pa.array(qid), lists], ["qid", "nbrs"]).filter(pa.array(n > 0))
    return body


def _merged(lists: DataFrame, k: int, hot: bool) -> DataFrame:
    """The ``k`` nearest of all lists of each query; ``hot``: an id of very many queries is cut part by part first."""
    top = F.slice(F.array_sort(F.flatten(F.collect_list("nbrs"))), 1, k).alias("nbrs")
    if hot:
        for parts in (4096, 64):
            lists = lists.groupBy("qid", F.pmod(F.xxhash64("nbrs"), F.lit(parts)).alias("part")).agg(top)
    return lists.groupBy("qid").agg(top)


def _smallest(df: DataFrame, keys: list[str], order: list[str], k: int, salt: str) -> DataFrame:
    """The first ``k`` rows of each key; a hot key is cut to k a part before it meets in one task."""
    part = Window.partitionBy(*keys, F.pmod(F.xxhash64(salt), F.lit(32))).orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("r_", F.row_number().over(part)).filter(F.col("r_") <= k)
            .withColumn("r_", F.row_number().over(whole)).filter(F.col("r_") <= k).drop("r_"))


def _vectors(df: DataFrame, idcol: str, xcol: str) -> DataFrame:
    x = F.col(xcol).cast("array<double>")
    return df.select(F.col(idcol).cast("long").alias("id"), x.alias("x"), F.xxhash64(x).alias("vh"))


def knn(queries: DataFrame, data: DataFrame, k: int, xcol: str = "x", idcol: str = "id",
        block: int = CELL_BLOCK) -> DataFrame:
    """Exact k nearest ``data`` points for every query: (qid, nbrs array<struct<dist,id>>)
    sorted by (dist, id). A query that is also a data point finds itself at distance 0."""
    none = F.array().cast("array<struct<dist:double,id:bigint>>")
    every = materialize(_vectors(queries, idcol, xcol))
    points = materialize(_smallest(_vectors(data, idcol, xcol), ["vh"], ["id"], k, "id"))
    n = points.count()
    if not n:
        return every.select(F.col("id").alias("qid"), none.alias("nbrs"))
    pivots = Pivots.choose(points, n, block)
    cells = pivots.assign(points.select("id", "x"))
    pivots.measure(cells)
    one = every.groupBy("vh").agg(F.min("id").alias("id"), F.min("x").alias("x"))
    asked = pivots.assign(one.select("id", "x"))
    # the nearest cells that hold k rows together, for each query cell
    seeds = []
    for row in _distances(pivots.points, pivots.points):
        order = [int(c) for c in np.argsort(row, kind="stable") if pivots.count[c]]
        seeds.append(order[:int(np.searchsorted(np.cumsum(pivots.count[order]), k)) + 1])
    hot = bool(one.groupBy("id").count().where("count > 64").head(1))
    data_rows = cells.select("id", "x", "cell")
    first = _join_cells(asked.select("id", "x", "cell"), data_rows, pivots, _top(k), NEAREST, arrow=True, seeds=seeds)
    # a hair more than the k-th distance, which is met again
    kth = F.when(F.size("nbrs") >= k, F.element_at("nbrs", k)["dist"] * (1 + _SLACK)).otherwise(F.lit(float("inf")))
    bound = _merged(first, k, hot).select("qid", kth.alias("reach"))
    asked = materialize(asked.join(bound, asked["id"] == bound["qid"]).select("id", "x", "cell", "reach"))
    best = _merged(_join_cells(asked, data_rows, pivots, _top(k), NEAREST, arrow=True, reach="reach"), k, hot)
    lists = best.join(one.select(F.col("id").alias("qid"), "vh"), "qid").select("vh", "nbrs")
    return every.join(materialize(lists), "vh", "left").select(F.col("id").alias("qid"), F.coalesce("nbrs", none).alias("nbrs"))


class RangeIndex:
    """Distinct vectors of a table for range searches of one radius."""

    def __init__(self, df: DataFrame, eps: float, idcol: str = "id", xcol: str = "x", block: int = CELL_BLOCK):
        self.eps, self.block = eps, block
        self.rows = materialize(_vectors(df, idcol, xcol))
        points = materialize(self.rows.groupBy("vh").agg(F.min("id").alias("id"), F.min("x").alias("x"),
                                                         F.count(F.lit(1)).alias("weight")))
        self.pivots = Pivots.choose(points, points.count(), block)
        self.points = None
        if len(self.pivots.points):
            self.points = self.pivots.assign(points.select("id", "x", "vh", "weight"))
            self.pivots.measure(self.points)

    def _run(self, queries: DataFrame, data: DataFrame, body: Callable, schema: str, **need) -> DataFrame:
        def run(q: pa.Table, c: pa.Table) -> pa.Table:
            return pa.table(body(_columns(q), _columns(c)))

        return _join_cells(queries, data, self.pivots, run, schema, arrow=True, **({"reach": self.eps} | need))

    def degrees(self) -> DataFrame:
        """(id, degree): rows within eps of each distinct vector, itself included."""
        eps = self.eps

        def body(q, c):
            ids, met = q["id"].astype(np.int64), c["id"].astype(np.int64)
            n, n_met = np.zeros(len(ids), np.int64), np.zeros(len(met), np.int64)
            if len(ids) and len(met):
                balls, weight, own, other = Balls(c["x"]), c["weight"].astype(np.int64), q["weight"].astype(np.int64), q["other"].astype(bool)
                for back in (False, True):  # rows of another bin are met once, and count on both sides
                    at = np.flatnonzero(other == back)
                    for r, whole, some, hit in balls.within(q["x"][at], eps):
                        n[at[whole]] += weight[r].sum()
                        n[at[some]] += _counts(hit, weight[r])
                        if back:
                            n_met[r] += own[at[whole]].sum() + _column_counts(hit, own[at[some]])
            held = n_met > 0
            return {"id": np.concatenate([ids, met[held]]), "n": np.concatenate([n, n_met[held]])}

        p = self.points.select("id", "x", "weight", "cell")
        return self._run(p, p, body, "id long, n long", half=True).groupBy("id").agg(F.sum("n").alias("degree"))

    def links(self, labels: DataFrame, asked: Column | None = None, own_cell: bool = False) -> DataFrame:
        """(a, b): links that span the labels of the core vectors (id, label) within eps of each other, task by
        task; with ``asked`` of the queries so chosen only, with ``own_cell`` inside cells only."""
        eps = self.eps

        def body(q, c):
            a, b = (t["label"].astype(np.int64) for t in (q, c))
            names = np.unique(np.concatenate([a, b]))
            label = np.arange(len(names))
            at_a, at_b = np.searchsorted(names, a), np.searchsorted(names, b)

            def join(i, j):
                while True:
                    x, y = label[i], label[j]
                    if (x == y).all():
                        return
                    np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                    while not np.array_equal(label[label], label):
                        label[:] = label[label]

            def apart(at, r):  # queries and rows under one label have no link to look for
                x, y = label[at_a[at]], label[at_b[r]]
                queries = np.arange(len(at))
                if (x == x[0]).all():
                    r = r[y != x[0]]
                elif (y == y[0]).all():
                    queries = np.flatnonzero(x != y[0])
                return queries, r

            if len(a) and len(b) and len(names) > 1:
                for r, whole, some, hit in Balls(c["x"]).within(q["x"], eps, apart):
                    if len(whole):
                        join(at_a[whole], np.full(len(whole), at_b[r[0]]))
                        join(at_b[r], np.full(len(r), at_a[whole[0]]))
                    if len(some):
                        i, j = np.divmod(np.flatnonzero(hit & (label[at_a[some]][:, None] != label[at_b[r]])), len(r))
                        join(at_a[some[i]], at_b[r[j]])
            own = label != np.arange(len(names))
            return {"a": names[own], "b": names[label[own]]}

        p = materialize(self.points.join(labels, "id").select("id", "x", "label", "cell"))
        if own_cell:
            return self._run(p, p, body, "a long, b long", seeds=[[c] for c in range(len(self.pivots.points))])
        queries = p if asked is None else p.where(asked)
        # what a query of one bin finds in another need not be found from there, unless not all are asked
        return self._run(queries, p, body, "a long, b long", labels=self._labels_of_cells(p), half=asked is None)

    def _labels_of_cells(self, labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest label in each cell; where there is none, the least is the larger one."""
        held = labelled.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).toPandas()  # at most MAX_PIVOTS
        low, high = np.ones(len(self.pivots.points), np.int64), np.zeros(len(self.pivots.points), np.int64)
        low[held["cell"]], high[held["cell"]] = held["low"], held["high"]
        return low, high

    def least_label(self, rest: DataFrame, labels: DataFrame) -> DataFrame:
        """(id, label): the least label of a core vector within eps of each vector of ``rest``."""
        eps, none = self.eps, np.iinfo(np.int64).max

        def body(q, c):
            ids = q["id"].astype(np.int64)
            least = np.full(len(ids), none)
            if len(ids) and len(c["id"]):
                label = c["label"].astype(np.int64)
                for r, whole, some, hit in Balls(c["x"]).within(q["x"], eps):
                    least[whole] = np.minimum(least[whole], label[r].min())
                    i, j = np.divmod(np.flatnonzero(hit), len(r))
                    np.minimum.at(least, some[i], label[r[j]])
            return {"id": ids[least < none], "l": least[least < none]}

        q = self.points.join(rest, "id", "left_semi").select("id", "x", "cell")
        c = materialize(self.points.join(labels, "id").select("id", "x", "label", "cell"))
        least = self._run(materialize(q), c, body, "id long, l long", labels=self._labels_of_cells(c))
        return least.groupBy("id").agg(F.min("l").alias("label"))
