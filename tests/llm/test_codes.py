"""Product codes against a plain implementation in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import codes
from vintage.llm.queries import QUERIES


def whole(x):
    n, d = float(x).as_integer_ratio()
    return n * 1024 // d


def plain(rows, entries=256, rounds=4):
    """(code, error) per row and the codebooks. rows: (id, vector, label)."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) % 4 == 0]
    if not kept:
        return {}, []
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = min(kept, key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))[1]
    order = [r for r in order if len(r[1]) == len(width)]
    span = len(width) // 4
    parts = [[[whole(x) for x in r[1][p * span:(p + 1) * span]] for p in range(4)] for r in order]
    books = [[row[p] for row in parts[:entries]] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        after = []
        for p, book in enumerate(books):
            got = [nearest(row[p], book)[1] for row in parts]
            after.append([[sum(v) // len(v) for v in zip(*own)] if (own := [parts[i][p] for i, g in enumerate(got) if g == e]) else book[e]
                          for e in range(len(book))])
        books = after
    out = []
    for r, row in zip(order, parts):
        best = [nearest(x, book) for x, book in zip(row, books)]
        error = sum(d for d, _ in best)
        out.append((r[0], "".join(f"{i:02x}" for _, i in best), error if error < 1 << 63 else None, r[2]))
    return out, books


def check(spark, rows, kind="double"):
    df = spark.createDataFrame([(*r, 7) for r in rows], f"vec_id long, embedding array<{kind}>, label int, codes int").repartition(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    coded, books = codes.compress(df)
    got = sorted(map(repr, ((r.vec_id, r.codes.hex(), r.error, r.label) for r in coded.collect())))
    want, shelf = plain(rows)
    assert got == sorted(map(repr, want))
    assert [[[int(x) for x in e] for e in b] for b in books] == shelf


def test_codes_are_brute_force(spark):
    rng = random.Random(1)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(rng.randrange(900), [m + rng.gauss(0, 0.2) for m in rng.choice(middles)], rng.choice([None, 1, 2])) for _ in range(420)]
    rows += [rows[3], rows[3], (None, rows[4][1], 1), (None, rows[5][1], None), (5000, None, 1), (5001, [], 1), (5002, [1.0] * 6, 1), (5003, [1.0] * 12, 1),
             (5004, [float("nan")] * 8, 1), (5005, [float("inf")] * 8, 2), (5006, [None] + [1.0] * 7, 2), (5007, [0.0] * 8, 2), (5008, [-0.0] * 8, 2)]
    check(spark, rows)


def test_ties_go_to_the_lower_entry(spark):
    check(spark, [(i, [float(i % 3), 0.0, 0.0, float(i % 2)], 1) for i in range(30)], "float")


@pytest.mark.parametrize("kind,top", [("float", 3e38), ("double", 1.7e308)])
def test_components_of_any_size(spark, kind, top):
    rng = random.Random(2)
    check(spark, [(i, [rng.choice([top, -top / 3, 1e5, 2.0 ** 41 + 3, 0.001]) * rng.random() for _ in range(4)], 1) for i in range(30)], kind)


def test_nothing(spark):
    check(spark, [])
    check(spark, [(1, None, 1), (2, [1.0, 2.0], 1)])


def test_label_errors(spark):
    coded = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (3, None, 7), (4, None, 8), (5, 2, None), (6, 2, 1), (7, 3, 2 ** 62), (8, 3, 2 ** 62)],
                                  "vec_id long, label int, error long")
    got = {r.vec_id: r.label_error for r in codes.label_errors(coded).collect()}
    assert got == {1: 11, 2: 11, 3: 15, 4: 15, 5: None, 6: None, 7: None, 8: None}


def test_bounds_hold_and_spare_distances():
    """Every bound lies below what it bounds, codes equal a full scan, and
    net displacement spares more than the sum of the moves."""
    rng = np.random.default_rng(4)
    middles = rng.integers(-2000, 2000, (64, 6))
    rows = (middles[rng.integers(0, 64, 3000)] + rng.integers(-60, 60, (3000, 6))).astype(float)
    book = rows[:128].copy()
    groups = 128 // codes.GROUP
    history, code = [], None
    bound, stamp = np.zeros((3000, groups), np.float32), np.zeros((3000, groups), np.uint8)
    for t in range(5):
        history.append(book)
        code, error, measured = codes.assign(rows, history, code, bound, stamp)
        d = ((rows[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
        rest = np.sqrt(d)
        rest[np.arange(3000), code] = np.inf
        net = np.stack([codes._net(book, then) for then in history])
        now = bound - net[stamp, np.arange(groups)[None, :]]
        assert (now <= rest.reshape(3000, groups, -1).min(axis=2)).all()
        assert t == 0 or measured < 0.6 * d.size
        drift = sum(codes._net(b, a) for a, b in zip(history, history[1:])) if t else 0
        assert (net[0] <= drift + 1e-6).all()
        book = np.stack([np.floor(rows[code == e].sum(axis=0) / (code == e).sum()) if (code == e).any() else book[e] for e in range(128)])


def test_query_on_a_table_of_one(spark, tmp_path):
    spark.createDataFrame([(3, [0.5, 0.25, -0.5, 1.0], None)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    r = QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()[0]
    assert (r.vec_id, r.code, r.error, r.label_error) == (3, "00000000", 0, 0)
    assert r.codebooks_sha256 == codes.hashlib.sha256(b"512,256,-512,1024").hexdigest()
