"""Embedding near-duplicates: an exact metric range join.

Unit vectors with cosine of at least c are points within r = sqrt(2 - 2c) of
each other. Pivots, drawn from the vectors of a label, partition its space:
a vector's home is the cell of its nearest pivot, inner ring (within r / 2 of
the pivot) or outer. A vector visits another cell only if the triangle
inequality leaves room for a partner there: its distance to that cell's
pivot may be at most r beyond the cell's own distances, and it may be at
most r beyond the plane half-way between the two pivots. Of two cells the
later one compares, so each pair meets once. Members of an inner ring are all
linked with each other by the same inequality, without being compared.

Cells join independently: a cell's home rows are split into blocks of about
``BLOCK`` rows, the block is held as a matrix and everything that visits it
streams by in Arrow batches, so memory is bounded whatever a cell holds.
A block returns one row per vector that it linked: its number of links and
an edge to the block's local component, never the pairs.

Equal vectors are one row with a count before any of this. At most
``MAX_PIVOTS`` pivots are drawn in all, in proportion to the labels' sizes;
pivots and the cells' radii are the only things that are broadcast.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, or whose label is null, link with nothing and are
their own component; vectors of different length are not compared; rows of
one id are one node; an empty table gives an empty result. Rows without an
id link like any other, and each is a vector of its own; as they have no name, their
component is the smallest id that they reach, or null where none has one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm import graph
from vintage.llm.common import checkpointed, ship

#: Rows per pivot aimed at, pivots at most, rows of a block aimed at.
CELL = 2048
MAX_PIVOTS = 2048
BLOCK = 2048
_EPS = 1e-9


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    m = np.stack([np.frombuffer(x, kind) for x in raw]).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _columns(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).alias("v"))


def _linkable() -> Column:
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False))


def _unlinkable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    return _columns(vectors, id_col, vec_col, label_col).filter(~_linkable())


def _packed(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, grp, vec binary) of the vectors that can link."""
    rows = _columns(vectors, id_col, vec_col, label_col).filter(_linkable())

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
            # 0.0 and -0.0 are equal
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind) + kind(0)
            ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)) * flat.itemsize
            bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32)).buffers()[1]
            packed = pa.Array.from_buffers(pa.binary(), len(column), [None, bounds, pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["vec_id", "grp", "vec"])

    grp = F.concat_ws(":", F.size("v"), "label")
    return rows.select("vec_id", grp.alias("grp"), "v").mapInArrow(run, "vec_id long, grp string, vec binary")


def _assign(shared, kind):
    """Per batch: unit vectors, and of each group's rows the distances to its pivots."""
    def batches_of(batches):
        pivots = {g: _unit(raw, kind) for g, raw in shared.value.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                groups = np.array(part.column(part.schema.get_field_index("grp")).to_pylist(), object)
                raw = part.column(part.schema.get_field_index("vec")).to_pylist()
                for g in dict.fromkeys(groups.tolist()):
                    rows = np.flatnonzero(groups == g)
                    m = _unit([raw[i] for i in rows], kind)
                    if g in pivots:
                        d = np.sqrt(np.maximum(0.0, 2 - 2 * (m @ pivots[g].T)))
                    else:
                        d = np.full((len(rows), 1), np.sqrt(2.0))
                    yield part, g, rows, m, d, pivots.get(g)
    return batches_of


def _links(home: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
    """Which pairs reach the cosine; doubtful ones are decided by the plain formula."""
    c = home @ other.T
    hit = c >= least
    for i, j in np.argwhere(np.abs(c - least) < 1e-12):
        x, y = home[i], other[j]
        hit[i, j] = float((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum())) >= least
    return hit


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    least: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``vectors``."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    ship(spark)
    radius = math.sqrt(2 - 2 * least)
    kind = "<f4" if "float" in dict(vectors.dtypes)[vec_col] else "<f8"
    rows = checkpointed(_packed(vectors, id_col, vec_col, label_col))
    # a class is named by a number of its own, fixed by the checkpoint: all its ids may be null
    classes = checkpointed(rows.groupBy("grp", "vec").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
                           .withColumn("node", F.monotonically_increasing_id()))

    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > CELL)
    total = classes.count()
    per = max(CELL, -(-total // MAX_PIVOTS))
    draw = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < F.lit(float(1 << 30) / per)
    drawn: dict[str, list[bytes]] = {}
    # about one in ``per`` rows, so near MAX_PIVOTS in all
    for r in classes.filter(draw).join(sizes, "grp", "left_semi").select("grp", "vec").orderBy("grp", "vec").limit(2 * MAX_PIVOTS).collect():
        drawn.setdefault(r["grp"], []).append(bytes(r["vec"]))
    pivots = sc.broadcast(drawn)
    assign = _assign(pivots, kind)

    def homes(batches):
        for part, g, rows, m, d, _ in assign(batches):
            cell = d.argmin(axis=1)
            near = d[np.arange(len(rows)), cell]
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(i).take(take) for i in range(4)] + [pa.array(cell.astype(np.int32)),
                 pa.array((near > radius / 2 - _EPS).astype(np.int32)), pa.array(near)],
                names=["grp", "vec", "node", "n", "cell", "ring", "near"])

    placed = checkpointed(classes.select("grp", "vec", "node", "n").mapInArrow(
        homes, "grp string, vec binary, node long, n long, cell int, ring int, near double"))
    stats = placed.groupBy("grp", "cell", "ring").agg(
        F.count(F.lit(1)).alias("rows"), F.min("near").alias("lo"), F.max("near").alias("hi"))
    # a label without pivots is one cell, which needs no radius: at most two rows per pivot remain
    shape: dict[str, list[tuple]] = {}
    for r in stats.join(sizes.select("grp"), "grp", "left_semi").collect():
        shape.setdefault(r["grp"], []).append((r["cell"], r["ring"], r["rows"], r["lo"], r["hi"]))
    cells = sc.broadcast({g: np.array(sorted(x)) for g, x in shape.items()})

    def meet(batches):
        """Every vector to its home block and to the blocks it visits."""
        for part, g, rows, m, d, piv in assign(batches):
            column = lambda name: part.column(part.schema.get_field_index(name))
            node = column("node").to_numpy()[rows]
            cell, ring = column("cell").to_numpy()[rows], column("ring").to_numpy()[rows]
            pick = node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            take, at_cell, at_ring, at_block, is_home = [], [], [], [], []

            def put(which, c, q, block, home):
                take.append(which), at_cell.append(np.full(len(which), c)), at_ring.append(np.full(len(which), q))
                at_block.append(block if isinstance(block, np.ndarray) else np.full(len(which), block))
                is_home.append(np.full(len(which), home))

            table = cells.value.get(g)
            if table is None:
                table = np.array([[0, 1, len(rows), 0.0, 2.0]])
            for c, q, count, lo, hi in table:
                c, q = int(c), int(q)
                blocks = max(1, -(-int(count) // BLOCK))
                own = np.flatnonzero((cell == c) & (ring == q))
                block = (pick[own] % np.uint64(blocks)).astype(np.int64)
                put(own, c, q, block, 1)
                if q == 1:
                    for b in range(1, blocks):
                        put(own[block < b], c, q, b, 0)
                before = (cell < c) | ((cell == c) & (ring < q))
                if piv is None or not before.any():
                    continue
                here = d[:, c]
                room = before & (here - hi <= radius + _EPS) & (lo - here <= radius + _EPS)
                if room.any():
                    gap = np.sqrt(np.maximum(0.0, 2 - 2 * (piv[cell] @ piv[c])))
                    mine = d[np.arange(len(rows)), cell]
                    room &= (here ** 2 - mine ** 2 <= 2 * gap * radius + _EPS) | (cell == c)
                    goes = np.flatnonzero(room)
                    for b in range(blocks):
                        put(goes, c, q, b, 0)
            which = np.concatenate(take)
            pos = pa.array(rows[which])
            yield pa.RecordBatch.from_arrays(
                [column("grp").take(pos), pa.array(np.concatenate(at_cell).astype(np.int32)), pa.array(np.concatenate(at_ring).astype(np.int32)),
                 pa.array(np.concatenate(at_block).astype(np.int32)), pa.array(1 - np.concatenate(is_home).astype(np.int32)),
                 column("vec").take(pos), column("node").take(pos), column("n").take(pos)],
                names=["grp", "cell", "ring", "block", "visits", "vec", "node", "n"])

    key = ["grp", "cell", "ring", "block"]
    met = (placed.mapInArrow(meet, "grp string, cell int, ring int, block int, visits int, vec binary, node long, n long")
           .repartition(*key).sortWithinPartitions(*key, "visits", "node"))

    def join(batches):
        """Homes of a block first, then its visitors batch by batch."""
        block, home = None, []

        def close():
            if not home:
                return
            m, node, count, label = home
            hit = np.flatnonzero(count > 0)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(count[hit]), pa.array(node[label[hit]])], names=["node", "links", "to"])

        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            visits = batch.column(4).to_numpy()
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or visits[i] != visits[i - 1]], len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != block:
                    yield from close()
                    block, home = keys[a], []
                for s in range(a, b, 2048):
                    e = min(b, s + 2048)
                    m = _unit(batch.column(5).slice(s, e - s).to_pylist(), kind)
                    node, n = batch.column(6).to_numpy()[s:e].copy(), batch.column(7).to_numpy()[s:e].copy()
                    if not visits[s]:
                        # home rows: compare with those already here and with each other
                        if not home:
                            home = [np.zeros((0, m.shape[1])), node[:0], n[:0], np.zeros(0, np.int64)]
                            weight = n[:0]
                        old = len(home[1])
                        home = [np.concatenate([home[0], m]), np.concatenate([home[1], node]), np.concatenate([home[2], 0 * n]),
                                np.concatenate([home[3], np.arange(old, old + len(node))])]
                        weight = np.concatenate([weight, n])
                        if block[2] == 1:
                            hit = _links(home[0], m, least)
                            hit[old + np.arange(len(node)), np.arange(len(node))] = False
                            home[2][:old] += hit[:old] @ n
                            home[2][old:] += hit.T.astype(np.int64) @ weight
                            for j in np.flatnonzero(hit.any(axis=0)):
                                _merge(home[3], np.append(np.flatnonzero(hit[:, j]), old + j))
                    elif home:
                        hit = _links(home[0], m, least)
                        rows = np.flatnonzero(hit.any(axis=0))
                        home[2] += hit @ n
                        for j in rows:
                            _merge(home[3], np.flatnonzero(hit[:, j]))
                        if len(rows):
                            to = home[1][home[3][hit[:, rows].argmax(axis=0)]]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(node[rows]), pa.array(hit.T[rows].astype(np.int64) @ weight), pa.array(to)], names=["node", "links", "to"])
        yield from close()

    found = checkpointed(met.mapInArrow(join, "node long, links long, to long"))
    # inner rings: all linked, nothing compared
    inner = placed.filter("ring = 0")
    whole = inner.groupBy("grp", "cell").agg(F.sum("n").alias("all"), F.min("node").alias("to"))
    ring = inner.join(whole, ["grp", "cell"]).select("node", (F.col("all") - F.col("n")).alias("links"), "to")
    every = found.union(ring)
    counts = every.groupBy("node").agg(F.sum("links").alias("links"))
    parts = graph.components(every.select(F.col("node").alias("a"), F.col("to").alias("b")))
    reached = classes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = reached.groupBy("component").agg(F.min("id").alias("component_id"))
    named = (reached.join(counts, "node", "left").join(first, "component")
             .select("grp", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    found = rows.join(named, ["grp", "vec"])
    # rows without an id stay one by one; the others are one node an id
    mine = (found.filter("vec_id is not null").groupBy("vec_id")
            .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    alone = _unlinkable(vectors, id_col, vec_col, label_col)
    nameless = found.filter("vec_id is null").select("vec_id", "n_links", "component_id").union(
        alone.filter("vec_id is null").select("vec_id", F.lit(0).cast("long"), F.lit(None).cast("long")))
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id")).filter("vec_id is not null")
    return ids.join(mine, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).union(nameless)


def _merge(label: np.ndarray, rows: np.ndarray) -> None:
    """Local components: the rows become one, named by the smallest."""
    names = np.unique(label[rows])
    if len(names) > 1:
        label[np.isin(label, names)] = names[0]
