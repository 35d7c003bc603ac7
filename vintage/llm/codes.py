"""Vector code compression: product codes with norm-of-sum bounds.

Vectors become integers, are cut into ``PARTS`` equal parts, and every part
is coded by the nearest of at most ``ENTRIES`` codebook entries. Rounds
assign all parts and move the entries to the floor of their parts' means.

Bounds spare most of the distances. For each part a row keeps, per group of
entries, a lower bound of its distance to the group's entries other than its
own, and the round in which that bound was measured. The codebooks of all
rounds are kept, so a bound of round s is lowered in round t by the largest
*net* displacement |c_t - c_s| of the group's entries: the norm of the sum of
their moves, which is tighter than adding up the norms. A group whose lowered
bound still exceeds the exact distance to the row's own entry is left out;
the others are measured again, and their bounds carry the new round's stamp.

Distances are exact: integers in double precision while every square sum
stays below 2^53, else Python integers, then without bounds. The comparison
of a bound allows for rounding, ties go to the exact measure.

A round is one pass: it reads the last round's table, writes (row, codes,
bounds, stamps) and, per task and entry, the sums of the parts assigned to
it, as Parquet in the shared folder; sums are added up by Spark. Only
codebooks (``PARTS`` x ``ENTRIES`` entries for each round) are broadcast or
reach the driver. A round's table is removed once the next one stands.

Defined results: vectors that are null or hold null or non-finite components
are dropped; so are those whose length is no positive multiple of ``PARTS`` or
differs from that of the smallest remaining id (nulls last); repeated rows
are rows of their own; ids that tie are ordered by their vector; rows without
an id come after all others; fewer rows than ``ENTRIES`` make fewer entries; an
error beyond a long is null; no rows give an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import ship
from vintage.session import checkpoint_dir

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Entries of a group that share a bound.
GROUP = 16
#: Sums are carried as digits of so many bits, so that they fit a long at any size.
LIMB = 24
#: Rows measured at a time.
SLAB = 4096


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    """The components as integers, in doubles where those are exact, else as Python integers."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    if np.isfinite(scaled).all():
        return scaled
    # beyond the range of doubles
    return np.array([[int(v) * SCALE if abs(v) > 2.0 ** 60 else int(np.floor(v * SCALE)) for v in row] for row in x], object).reshape(-1, width)


def _exact(largest: int, width: int) -> bool:
    """Whether doubles hold every squared distance of a part exactly."""
    return width * (2 * largest) ** 2 < 1 << 53


def _squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, all integers: exact in the type of ``rows``."""
    return (rows * rows).sum(axis=1)[:, None] - 2 * (rows @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def _net(now: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Of each group the largest displacement of an entry, rounded up."""
    moved = np.sqrt(((now - then) ** 2).sum(axis=1)) * (1 + 1e-12)
    return np.array([moved[g:g + GROUP].max() for g in range(0, len(now), GROUP)])


def assign(rows: np.ndarray, history: list[np.ndarray], code: np.ndarray | None, bound: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(code, squared distance, distances measured) of the part ``rows``
    (n, width) against the last codebook of ``history``; ``bound`` and ``stamp``
    (n, groups) are renewed in place. ``code`` is that of the round before,
    None in the first."""
    now, n = history[-1], len(rows)
    at, every = len(history) - 1, np.arange(n)
    groups = -(-len(now) // GROUP)
    if rows.dtype == object:
        d = _squares(rows, now)
        code = d.argmin(axis=1)
        return code, d[every, code], d.size
    if code is None:
        old, best, nearest = None, np.full(n, np.inf), np.zeros(n, np.int64)
        open_groups = np.ones((n, groups), bool)
    else:
        old, nearest = code, code.copy()
        best = ((rows - now[code]) ** 2).sum(axis=1)
        shrunk = np.stack([_net(now, then) for then in history])  # (rounds, groups)
        reach = bound - shrunk[stamp, np.arange(groups)[None, :]]
        # 1e-6 is far above any rounding of the bounds, which are singles rounded down
        open_groups = reach * (1 - 1e-9) - 1e-6 <= np.sqrt(best)[:, None]
        mine = best.copy()
    measured = n
    low: dict[int, tuple] = {}
    for g in range(groups):
        which = np.flatnonzero(open_groups[:, g])
        if not len(which):
            continue
        d = _squares(rows[which], now[g * GROUP:(g + 1) * GROUP])
        measured += d.size
        at_least = d.argmin(axis=1)
        least = d[np.arange(len(which)), at_least]
        entry = at_least + g * GROUP
        better = (least < best[which]) | ((least == best[which]) & (entry < nearest[which]))
        best[which[better]], nearest[which[better]] = least[better], entry[better]
        low[g] = (which, d)
    for g, (which, d) in low.items():
        # without the row's own entry
        own = np.flatnonzero(nearest[which] // GROUP == g)
        d[own, nearest[which[own]] - g * GROUP] = np.inf
        bound[which, g] = _down(np.sqrt(d.min(axis=1)))
        stamp[which, g] = at
    if old is not None:
        # the entry a row has left counts for its group again
        left = np.flatnonzero(old != nearest)
        g = old[left] // GROUP
        kept = ~open_groups[left, g]
        left, g = left[kept], g[kept]
        bound[left, g] = _down(np.minimum(reach[left, g], np.sqrt(mine[left])))
        stamp[left, g] = at
    return nearest, best, measured


def _down(x: np.ndarray) -> np.ndarray:
    single = np.minimum(x, 3e38).astype(np.float32)
    return np.nextafter(single, np.float32(-np.inf))


def _limbs(v: int) -> list[int]:
    """Digits of a sum, the sign in the last."""
    out = []
    while not -(1 << LIMB) < v < (1 << LIMB):
        out.append(v & ((1 << LIMB) - 1))
        v >>= LIMB
    return [*out, v]


_STATE = "vec_id long, label {label}, vec array<{kind}>, codes binary, bounds binary, stamps binary, error long, slot int, n long, sums array<array<long>>"


def _pass(width: int, history: list[list[np.ndarray]], exact: bool, schema: pa.Schema, last: bool):
    """One round over a partition; in the end one row per part and entry that
    it used, with the sum of the parts. ``history[part][round]`` are codebooks."""
    span = width // PARTS
    kind = np.float64 if exact else object
    first = len(history[0]) == 1
    names = schema.names

    def run(batches):
        books = [[np.array(b, kind) for b in h] for h in history]
        entries = len(books[0][-1])
        groups = -(-entries // GROUP)
        total = np.zeros((PARTS, entries, span), np.int64 if exact else object)
        count = np.zeros((PARTS, entries), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, SLAB):
                batch = whole.slice(at, SLAB)
                n = batch.num_rows
                x = _numbers(batch.column("vec"), width)
                x = x if exact else np.array([[int(v) for v in row] for row in x], object).reshape(n, width)
                shape = (n, PARTS, groups)
                if first:
                    codes, bounds, stamps = np.zeros((n, PARTS), np.uint8), np.zeros(shape, np.float32), np.zeros(shape, np.uint8)
                else:
                    codes, bounds, stamps = [np.frombuffer(b"".join(batch.column(c).to_pylist()), k).copy() for c, k in
                                             (("codes", np.uint8), ("bounds", np.float32), ("stamps", np.uint8))]
                    codes, bounds, stamps = codes.reshape(n, PARTS), bounds.reshape(shape), stamps.reshape(shape)
                errors = []
                for p in range(PARTS):
                    part = x[:, p * span:(p + 1) * span]
                    code, error, _ = assign(part, books[p], None if first else codes[:, p].astype(np.int64), bounds[:, p], stamps[:, p])
                    codes[:, p] = code
                    errors.append(error)
                    if exact:
                        for at_column in range(span):
                            total[p][:, at_column] += np.bincount(code, part[:, at_column], entries).astype(np.int64)
                    else:
                        np.add.at(total[p], code, part)
                    count[p] += np.bincount(code, minlength=entries)
                made = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "vec": batch.column("vec"),
                        "codes": pa.array([bytes(c) for c in codes], pa.binary())}
                if last:
                    made["error"] = pa.array([e if (e := int(sum(x))) < 1 << 63 else None for x in zip(*errors)], pa.int64())
                else:
                    made["bounds"] = pa.array([b.tobytes() for b in bounds], pa.binary())
                    made["stamps"] = pa.array([s.tobytes() for s in stamps], pa.binary())
                yield pa.RecordBatch.from_arrays([made[c] if c in made else pa.nulls(n, schema.field(c).type) for c in names], schema=schema)
        if last:
            return
        used = np.argwhere(count)
        made = {"slot": pa.array([int(p * entries + e) for p, e in used], pa.int32()), "n": pa.array([int(count[p, e]) for p, e in used], pa.int64()),
                "sums": pa.array([[_limbs(int(v)) for v in total[p, e]] for p, e in used], schema.field("sums").type)}
        if len(used):
            yield pa.RecordBatch.from_arrays([made[c] if c in made else pa.nulls(len(used), schema.field(c).type) for c in names], schema=schema)
    return run


def _moved(book: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """The next codebooks: floor of the mean of what each entry got."""
    entries = len(book[0])
    counts = {r["slot"]: r["n"] for r in sums.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    digits = (sums.select("slot", F.posexplode("sums").alias("at", "limbs")).select("slot", "at", F.posexplode("limbs").alias("limb", "v"))
              .groupBy("slot", "at", "limb").agg(F.sum("v").alias("v")))
    total: dict[tuple[int, int], int] = {}
    for r in digits.collect():
        total[r["slot"], r["at"]] = total.get((r["slot"], r["at"]), 0) + (r["v"] << (LIMB * r["limb"]))
    out = [b.copy() for b in book]
    for (slot, at), v in total.items():
        out[slot // entries][slot % entries, at] = v // counts[slot]
    return out


def _remove(spark, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, codes binary, error) of every kept row, codebooks by
    part as integer matrices)."""
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("vec")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    kept = rows.filter(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & fine)
    order = [F.col("vec_id").asc_nulls_last(), F.col("vec")]
    start = kept.select("vec_id", F.size("vec").alias("size")).orderBy(F.col("vec_id").asc_nulls_last(), "size").limit(1).collect()
    label, kind = rows.schema["label"].dataType.simpleString(), rows.schema["vec"].dataType.elementType.simpleString()
    if not start:
        return kept.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), []
    width = start[0]["size"]
    kept = kept.filter(F.size(v) == width)
    largest = kept.select(F.max(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))).alias("m")).collect()[0]["m"]
    exact = _exact(int(largest) * SCALE + SCALE, width // PARTS)
    seeds = [r["vec"] for r in kept.orderBy(*order).limit(ENTRIES).select("vec").collect()]
    seed = _numbers(pa.array(seeds, pa.list_(pa.float64())), width)
    whole = np.array([[int(x) for x in row] for row in seed], object).reshape(len(seeds), width)
    span = width // PARTS
    history = [[whole[:, p * span:(p + 1) * span]] for p in range(PARTS)]
    folder = f"{checkpoint_dir(spark)}/codes-{uuid.uuid4().hex}"
    state = _STATE.format(label=label, kind=kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(state))
    current = kept
    for t in range(ROUNDS + 1):
        last = t == ROUNDS
        current.mapInArrow(_pass(width, history, exact, schema, last), state).write.parquet(f"{folder}/{t}")
        if t >= 1:
            _remove(spark, f"{folder}/{t - 1}")
        done = spark.read.schema(state).parquet(f"{folder}/{t}")
        current = done.filter("slot is null").select("vec_id", "label", "vec", "codes", "bounds", "stamps")
        if not last:
            for h, book in zip(history, _moved([h[-1] for h in history], done.filter("slot is not null").select("slot", "n", "sums"))):
                h.append(book)
    return done.select("vec_id", "label", "codes", "error"), [h[-1] for h in history]


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over rows of equal
    label, nulls together: added up before it moves, joined on the label.
    Null if a row's error or the sum is beyond a long."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count("error") == F.count(F.lit(1))) & (total <= F.lit(2 ** 63 - 1).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.when(fits, total).cast("long").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
