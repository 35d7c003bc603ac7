"""Approximate nearest neighbours: stable projections, kd-trees, a chi-square stop.

Largest inner products become smallest distances: vectors are dealt into
bands by norm, a band's vectors get one more component that lifts all to its
largest norm M, and a query is scaled to norm M; then
|x' - q'|^2 = 2 M^2 - 2 x.q'. ``DIMS`` Gaussian (2-stable) projections keep
that distance r as r times the root of a chi-square variable. A kd-tree over
the projections gives neighbours by projected distance, and each is verified
on its full vector. Once the next projected distance d makes
chi2(d^2 / R^2) >= ``SURE``, R being the distance of the k-th best so far, a
vector not yet seen is nearer than R with a chance of at most 1 - ``SURE``: the
search stops. Every row is indexed and can be found, so recall is about
``SURE`` per neighbour, and better where the k-th best is far from the best.

The upper levels of the tree, fitted to at most ``SAMPLE`` projected rows, deal
the table into cells; a cell too large for a task is dealt into blocks. A
query first searches the cell it lies in, then, with the k-th best found
there, those cells whose bounding box passes the same test. In a cell the
block's points come first and become a tree, queries stream by in Arrow
batches; a cell with many queries is dealt into parts of them, each with its
own copy of the points. So a task holds one block, whatever the key.

Equal vectors tie: of those only the k + 1 smallest ids can be among the k
nearest (one may be the query's own), the others are left out beforehand by
a ranked limit. On the driver: the projected sample, and the counts and boxes
of at most ``MAX_CELLS`` cells for each length and band.

Defined results: rows that are null, empty, zero, hold null or non-finite
components or have no id take no part; equal rows are one; rows that share
an id but not the vector are candidates of their own, of such queries the
smallest vector is taken, and no row of the query's id is its neighbour;
vectors of another length than the query's are no candidates; fewer than k
candidates are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.common import ship
from vintage.session import checkpoint_dir

#: Projected dimensions (even, for the closed form of the chi-square test).
DIMS = 8
SURE = 0.98
#: Rows of a block aimed at, queries of a part, cells of a band at most, sampled rows, rows of a leaf.
BLOCK = 16384
ASKED = 16384
MAX_CELLS = 4096
SAMPLE = 20_000
LEAF = 64
SEED = 20


def chi2_cdf(x: float) -> float:
    """Of a chi-square variable with ``DIMS`` degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, DIMS // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def quantile(p: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        lo, hi = ((lo + hi) / 2, hi) if chi2_cdf((lo + hi) / 2) < p else (lo, (lo + hi) / 2)
    return hi


def projections(dim: int) -> np.ndarray:
    """(dim + 1, DIMS): the last row is that of the lifting component."""
    return np.random.default_rng(SEED).standard_normal((dim + 1, DIMS))


def _by_length(batch: pa.RecordBatch, name: str = "v"):
    """(length, rows, their vectors in doubles) of the lengths in a batch."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes = np.asarray(column.value_lengths())
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        own = column if len(rows) == len(sizes) else column.take(pa.array(rows))
        yield int(dim), rows, own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def _bands(norm: np.ndarray) -> np.ndarray:
    """Powers of two, with 1 well inside a band."""
    return np.floor(np.log2(norm) + 0.5).astype(np.int64)


def _project(x: np.ndarray, norm: np.ndarray, top: float) -> np.ndarray:
    """Projections of lifted vectors, for norms up to ``top`` in units of it."""
    p = projections(x.shape[1])
    lift = np.sqrt(np.maximum(0.0, 1 - (norm / top) ** 2))
    return (x / top) @ p[:-1] + lift[:, None] * p[-1]


# ----------------------------------------------------------------- the tree

def splits(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and cuts of a complete kd-tree with ``cells`` leaves (a power of two)."""
    axis, cut = np.zeros(cells - 1, np.int64), np.full(cells - 1, np.inf)
    parts = {0: sample}
    for node in range(cells - 1):
        rows = parts.pop(node)
        if len(rows):
            axis[node] = np.argmax(rows.max(axis=0) - rows.min(axis=0))
            cut[node] = np.median(rows[:, axis[node]])
        right = rows[:, axis[node]] > cut[node]
        parts[2 * node + 1], parts[2 * node + 2] = rows[~right], rows[right]
    return axis, cut


def cell_of(points: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    every = np.arange(len(points))
    for _ in range((len(axis) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[every, axis[node]] > cut[node])
    return node - len(axis)


def box_distances(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances (queries, boxes)."""
    out = np.zeros((len(q), len(lo)))
    for a in range(DIMS):
        out += np.maximum(0.0, np.maximum(lo[:, a][None, :] - q[:, a][:, None], q[:, a][:, None] - hi[:, a][None, :])) ** 2
    return out


class Tree:
    """A block's points: kd-tree leaves are runs of rows, with their boxes."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        p = _project(x, _norms(x), top)
        order = np.arange(len(x))
        runs = [order]
        while runs and max(map(len, runs)) > LEAF:
            after = []
            for r in runs:
                if len(r) <= LEAF:
                    after.append(r)
                    continue
                a = np.argmax(p[r].max(axis=0) - p[r].min(axis=0))
                r = r[np.argpartition(p[r, a], len(r) // 2)]
                after += [r[:len(r) // 2], r[len(r) // 2:]]
            runs = after
        order = np.concatenate(runs)
        self.ids, self.x, self.p, self.top = ids[order], x[order], p[order], top
        ends = np.cumsum([len(r) for r in runs])
        self.leaves = [np.arange(e - len(r), e) for r, e in zip(runs, ends)]
        self.lo = np.stack([self.p[i].min(axis=0) for i in self.leaves])
        self.hi = np.stack([self.p[i].max(axis=0) for i in self.leaves])

    def nearest(self, own: int, q: np.ndarray, qp: np.ndarray, boxes: np.ndarray, k: int, floor: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of at most k rows by inner product with ``q``, whose
        k-th best elsewhere is ``floor``. ``qp``: the projected query; ``boxes``:
        its squared distances to the leaves; ``bound``: the chi-square quantile."""
        size = math.sqrt(float((q * q).sum()))
        slack = 1e-12 * size * self.top * len(q)
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        order, at, step = np.argsort(boxes), 0, 1
        while at < len(order):
            # 2 - 2 cos, in units of the band's norm; slack keeps ties in reach
            reach = bound * max(0.0, 2 - 2 * (floor - slack) / (size * self.top))
            take = order[at:at + step]
            take = take[boxes[take] <= reach]
            if not len(take):
                break
            which = np.concatenate([self.leaves[i] for i in take])
            near = ((self.p[which] - qp) ** 2).sum(axis=1) <= reach
            which = which[near & (self.ids[which] != own)]
            rows, scores = np.concatenate([rows, which]), np.concatenate([scores, self.x[which] @ q])
            if len(rows) > k:
                floor = max(floor, np.partition(scores, len(scores) - k)[len(scores) - k])
            keep = scores >= floor - slack
            rows, scores = rows[keep], scores[keep]
            if len(rows) == k:
                floor = max(floor, scores.min())
            at, step = at + step, step * 2
        # equal vectors get equal scores: row by row, not by a blocked product
        scores = (self.x[rows] * q).sum(axis=1)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


# ------------------------------------------------------------------- stages

_KEY = ["dim", "band", "cell", "block", "part"]


def _mixed(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)


def _banded(batches):
    for batch in batches:
        for dim, rows, x in _by_length(batch):
            norm = _norms(x)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(rows), dim, np.int32)),
                                              pa.array(_bands(norm).astype(np.int32)), pa.array(norm)], names=["id", "v", "dim", "band", "norm"])


def _per_band(batch: pa.RecordBatch):
    """(dim, band, rows, vectors, norms) of a banded batch."""
    bands, norms = np.asarray(batch.column("band")), np.asarray(batch.column("norm"))
    for dim, rows, x in _by_length(batch):
        for band in np.unique(bands[rows]):
            own = bands[rows] == band
            yield dim, int(band), rows[own], x[own], norms[rows[own]]


def _block(dim: int) -> int:
    return max(256, min(BLOCK, (1 << 23) // dim))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` (same
    columns) the k nearest found among all ``vectors`` of another id."""
    spark = vectors.sparkSession
    ship(spark)
    sc = spark.sparkContext
    bound = quantile(SURE)
    folder = f"{checkpoint_dir(spark)}/nearest-{uuid.uuid4().hex}"
    kind = dict(vectors.dtypes)[vec_col]

    single = _usable(vectors, id_col, vec_col).groupBy("v", "id").agg(F.count(F.lit(1)).alias("times"))
    ranked = single.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("place") <= k + 1)
    ranked.select("id", "v").mapInArrow(_banded, f"id long, v {kind}, dim int, band int, norm double").write.parquet(f"{folder}/points")
    points = spark.read.parquet(f"{folder}/points")
    tops = {(r["dim"], r["band"]): (r["n"], r["top"]) for r in
            points.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).collect()}
    out = "query_id long, vec_id long, score double"
    if not tops:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    # the upper tree, from a bounded sample of projections
    total = sum(n for n, _ in tops.values())

    def projected(batches):
        for batch in batches:
            for dim, band, rows, x, norm in _per_band(batch):
                p = _project(x, norm, tops[dim, band][1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.full(len(rows), band, np.int32)),
                                                  pa.array(list(p))], names=["dim", "band", "p"])

    drawn = points.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / total))))
    sampled: dict[tuple[int, int], list] = {}
    for r in drawn.mapInArrow(projected, "dim int, band int, p array<double>").limit(2 * SAMPLE).collect():
        sampled.setdefault((r["dim"], r["band"]), []).append(r["p"])
    trees = {}
    for (dim, band), (n, _) in tops.items():
        rows = np.array(sampled.get((dim, band), []), float).reshape(-1, DIMS)
        cells = 1 << max(0, math.ceil(math.log2(n / _block(dim))))
        trees[dim, band] = splits(rows, max(1, min(cells, MAX_CELLS, 1 << max(0, (len(rows) // 8).bit_length() - 1))))
    upper = sc.broadcast((tops, trees))

    def boxed(batches):
        """Counts and bounds of the partition's rows, by cell and axis."""
        tops, trees = upper.value
        found: dict[tuple, list] = {}
        for batch in batches:
            for dim, band, rows, x, norm in _per_band(batch):
                p = _project(x, norm, tops[dim, band][1])
                cell = cell_of(p, *trees[dim, band])
                for c in np.unique(cell):
                    own = p[cell == c]
                    n, lo, hi = found.get((dim, band, int(c)), (0, np.inf, -np.inf))
                    found[dim, band, int(c)] = (n + len(own), np.minimum(lo, own.min(axis=0)), np.maximum(hi, own.max(axis=0)))
        rows = [(d, b, c, a, n, float(lo[a]), float(hi[a])) for (d, b, c), (n, lo, hi) in found.items() for a in range(DIMS)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["dim", "band", "cell", "axis", "n", "lo", "hi"])

    shape = points.mapInArrow(boxed, "dim long, band long, cell long, axis long, n long, lo double, hi double")
    boxes: dict[tuple[int, int], dict[int, list]] = {}
    for r in shape.groupBy("dim", "band", "cell", "axis").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        box = boxes.setdefault((r["dim"], r["band"]), {}).setdefault(r["cell"], [r["n"], np.zeros(DIMS), np.zeros(DIMS)])
        box[1][r["axis"]], box[2][r["axis"]] = r["lo"], r["hi"]
    cells = {key: (np.array(sorted(by)), np.array([-(-by[c][0] // _block(key[0])) for c in sorted(by)]),
                   np.stack([by[c][1] for c in sorted(by)]), np.stack([by[c][2] for c in sorted(by)])) for key, by in boxes.items()}
    grid = sc.broadcast((tops, trees, cells))

    def scaled(dim: int, x: np.ndarray):
        """For each band of a length: key, projected queries, their box distances."""
        unit = x / _norms(x)[:, None]
        for key, (_, top) in grid.value[0].items():
            if key[0] == dim:
                # the query's lifting component is 0
                qp = unit @ projections(dim)[:-1]
                yield key, top, box_distances(qp, *grid.value[2][key][2:])

    def visits(first: bool):
        """Which cells a query searches: where it lies, or all others that pass the test."""
        def run(batches):
            for batch in batches:
                ids = np.asarray(batch.column("id"))
                floor = np.asarray(batch.column("floor"))
                for dim, rows, x in _by_length(batch):
                    near = list(scaled(dim, x))
                    if not near:
                        continue
                    nearest = np.stack([d.min(axis=1) for _, _, d in near])
                    # of bands that tie, the one of the largest norm
                    best_band = np.lexsort((-np.array([t for _, t, _ in near])[:, None] + 0 * nearest, nearest), axis=0)[0]
                    size = _norms(x)
                    for b, (key, top, d) in enumerate(near):
                        home = (best_band == b)[:, None] & (np.arange(d.shape[1])[None, :] == d.argmin(axis=1)[:, None])
                        if first:
                            goes = home
                        else:
                            reach = bound * np.maximum(0.0, 2 - 2 * (floor[rows] / (size * top)) + 1e-12 * dim)
                            goes = ~home & (d <= reach[:, None])
                        which, at = np.nonzero(goes)
                        if len(which):
                            take = pa.array(rows[which])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(ids[rows[which]]), batch.column("v").take(take), pa.array(floor[rows[which]]), pa.array(np.full(len(which), dim, np.int32)),
                                 pa.array(np.full(len(which), key[1], np.int32)), pa.array(grid.value[2][key][0][at].astype(np.int32))],
                                names=["id", "v", "floor", "dim", "band", "cell"])
        return run

    def searched(asked: DataFrame, first: bool) -> DataFrame:
        name = "first" if first else "second"
        asked.mapInArrow(visits(first), f"id long, v {kind}, floor double, dim int, band int, cell int").write.parquet(f"{folder}/{name}-visits")
        goes = spark.read.parquet(f"{folder}/{name}-visits")
        load = {(r["dim"], r["band"], r["cell"]): -(-r["n"] // ASKED) for r in goes.groupBy("dim", "band", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = sc.broadcast(load)
        schema = f"dim int, band int, cell int, block int, part int, asks int, id long, floor double, v {kind}"
        names = ["dim", "band", "cell", "block", "part", "asks", "id", "floor", "v"]

        def dealt(batch, dim, band, cell, rows, block, part, asks, floor):
            take = pa.array(rows)
            whole = lambda v: pa.array(np.broadcast_to(np.asarray(v, np.int32), len(rows)))
            return pa.RecordBatch.from_arrays([whole(dim), whole(band), whole(cell), whole(block), whole(part), whole(asks),
                                               batch.column("id").take(take), pa.array(floor, pa.float64()), batch.column("v").take(take)], names=names)

        def points_out(batches):
            """Points to their block, once for each part of its cell's queries."""
            tops, trees, cells = grid.value
            for batch in batches:
                ids = np.asarray(batch.column("id"))
                for dim, band, rows, x, norm in _per_band(batch):
                    cell = cell_of(_project(x, norm, tops[dim, band][1]), *trees[dim, band])
                    order, blocks = cells[dim, band][:2]
                    block = (_mixed(ids[rows]) % blocks[np.searchsorted(order, cell)].astype(np.uint64)).astype(np.int32)
                    for c in np.unique(cell):
                        own = cell == c
                        for part in range(parts.value.get((dim, band, int(c)), 0)):
                            yield dealt(batch, dim, band, c, rows[own], block[own], part, 0, np.zeros(int(own.sum())))

        def queries_out(batches):
            """Queries to all blocks of a cell they visit."""
            cells = grid.value[2]
            for batch in batches:
                ids, floor = np.asarray(batch.column("id")), np.asarray(batch.column("floor"))
                key = np.stack([np.asarray(batch.column(c)) for c in ("dim", "band", "cell")], axis=1)
                for dim, band, cell in np.unique(key, axis=0):
                    rows = np.flatnonzero((key == (dim, band, cell)).all(axis=1))
                    order, blocks = cells[int(dim), int(band)][:2]
                    part = (_mixed(ids[rows]) % np.uint64(parts.value[int(dim), int(band), int(cell)])).astype(np.int32)
                    for block in range(int(blocks[np.searchsorted(order, cell)])):
                        yield dealt(batch, dim, band, cell, rows, block, part, 1, floor[rows])

        def answer(batches):
            """A key's points become a tree, then its queries are answered."""
            key, ids, held, tree = None, [], [], None
            for batch in batches:
                keys = np.stack([np.asarray(batch.column(i)) for i in range(6)], axis=1)
                cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    now = tuple(keys[a, :5].tolist())
                    if now != key:
                        key, ids, held, tree = now, [], [], None
                    part = batch.slice(a, b - a)
                    dim, _, x = next(_by_length(part, "v"))
                    own = np.asarray(part.column("id"))
                    if not keys[a, 5]:
                        ids.append(own.copy())
                        held.append(x)
                        continue
                    if not held and tree is None:
                        continue
                    top = grid.value[0][key[:2]][1]
                    if tree is None:
                        tree = Tree(np.concatenate(ids), np.concatenate(held), top)
                        ids, held = [], []
                    floor = np.asarray(part.column("floor"))
                    qp = (x / _norms(x)[:, None]) @ projections(dim)[:-1]
                    near = box_distances(qp, tree.lo, tree.hi)
                    got = [tree.nearest(own[i], x[i], qp[i], near[i], k, floor[i], bound) for i in range(len(x))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, [len(g[0]) for g in got])), pa.array(np.concatenate([g[0] for g in got])),
                                                      pa.array(np.concatenate([g[1] for g in got]))], names=["query_id", "vec_id", "score"])

        both = points.mapInArrow(points_out, schema).union(goes.mapInArrow(queries_out, schema))
        return both.repartition(*_KEY).sortWithinPartitions(*_KEY, "asks").mapInArrow(answer, out)

    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranks = F.row_number().over(nearest)
    asked = _usable(queries, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    none = F.lit(float("-inf"))
    searched(asked.select("id", "v", none.alias("floor")), True).withColumn("rank", ranks).filter(F.col("rank") <= k).drop("rank").write.parquet(f"{folder}/first")
    first = spark.read.schema(out).parquet(f"{folder}/first")
    floors = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    rest = asked.join(floors, F.col("id") == F.col("query_id"), "left").select("id", "v", F.coalesce("least", none).alias("floor"))
    every = first.union(searched(rest, False)).withColumn("rank", ranks).filter(F.col("rank") <= k)
    return every.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
