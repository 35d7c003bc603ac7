"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of a text (each step shifts the
hash by one bit and adds the table entry of the byte, so it depends on the
last ``WINDOW`` bytes only); a chunk ends at the word whose hash is smallest
among the ``REACH`` words before it and after it. So chunks have more than
``REACH`` words (but at a text's limits), 7 on average, and cuts depend on
what stands around them and not on where: an insertion moves later chunks
without changing them, and a passage that two texts share is cut alike in
both, but for its first and last words.

Chunks are deduplicated by digest (two of 64 bits). One aggregation over the
table, combined before the shuffle, gives every digest that occurs more than
once its number of places, its first place (smallest document, text, number)
and its last. Neighbouring chunks that all occur elsewhere are a run; a run
ends where first places begin or end. At both ends a run then grows word by
word into the chunk that is cut differently, as far as the ``EDGE`` words
there equal those at the first or at the last place of its outermost chunk.
Only these few hashes of words are compared; of the texts, those with runs
or places move once. A run of at least ``LEAST_WORDS`` words is a repeated
passage. In 51 words, fewer than two cuts are rarer than 1 in 100,000.

No digest is gathered in one task: the digests with a thousandth or more of
all repeated places, at most 1,000, are joined in ``SALTS`` parts, and the
places that many runs are compared with are dealt to them in parts.

Defined results: null text is an empty text and has no chunks; repeats
inside one document count as well; rows with the same id are one document
whose texts are numbered by content; rows without an id are documents after
all others, named by their text, and have a null ``doc_id`` (also as
``first_doc_id``; the largest long as an id reads as null too); of identical
rows (same id and text) one is the first and each other one a copy of it; an
empty table gives an empty result; chunks may be long (a text without white
space is one chunk). White space counts inside a chunk, not between chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.common import ship, written
from vintage.llm.textbatch import PLAIN, hashed, prefix, slices, spans

WINDOW = 16
REACH = 3
EDGE = 32
LEAST_WORDS = 15
#: Parts of a hot digest, and runs that one copy of a place is compared with.
SALTS = 64
RUNS = 2000

_GEAR = np.random.default_rng(20_240_611).integers(0, 1 << 16, 256, dtype=np.uint16)
#: Any other one-to-one map of bytes: its hash is the second digest.
_OTHER = np.random.default_rng(20_240_612).permutation(256).astype(np.uint8)
#: Order of documents without an id.
_LAST = (1 << 63) - 1


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of the last 16 bytes' entries, the k-th
    last shifted by k, modulo 2**16; doubling the window in each step."""
    h = _GEAR[data]
    k = 1
    while k < WINDOW:
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
        k *= 2
    return h


def closing(data: np.ndarray, bounds: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a chunk ends with the word; words by their ``end`` and ``row``."""
    h = rolling(data)
    # the first bytes of a row must not depend on the row before
    for b in bounds[1:-1]:
        part = data[b:b + WINDOW]
        h[b:b + len(part)] = rolling(part)
    value, n = h[end - 1], len(end)
    out = np.ones(n, bool)
    for k in range(1, min(REACH, n - 1) + 1):
        apart = row[k:] != row[:-k]
        out[k:] &= apart | (value[k:] < value[:-k])
        out[:-k] &= apart | (value[:-k] <= value[k:])
    out[:-1] |= row[1:] != row[:-1]
    out[-1:] = True
    return out


def _cut(column: pa.Array):
    """Per slice: (first row, words as (start, end, row), first and last word
    of every chunk, number of the chunk in its row, prefix sums, bytes, code
    point of every byte in its row, bounds)."""
    for first, data, bounds in slices(column):
        start, end, row = spans(data, bounds)
        if not len(start):
            continue
        last = np.flatnonzero(closing(data, bounds, end, row))
        begin = np.concatenate([[0], last[:-1] + 1])
        of = row[begin]
        number = np.arange(len(of)) - np.searchsorted(of, of)
        points = np.arange(len(data) + 1) if data.max() < 128 else np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        yield first, (start, end, row), (begin, last), number, prefix(data, PLAIN), data, points, bounds


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_id, chunk, start, end, n_words, digest, check): the chunks
    of every text that has words; start and end in code points."""
    def run(batches):
        for batch in batches:
            for first, (start, end, row), (begin, last), number, sums, data, points, bounds in _cut(batch.column(2)):
                a, b, of = start[begin], end[last], row[begin]
                base, rows = points[bounds[of]], pa.array(first + of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(number.astype(np.int32)),
                     pa.array((points[a] - base).astype(np.int32)), pa.array((points[b] - base).astype(np.int32)),
                     pa.array((last - begin + 1).astype(np.int32)), pa.array(hashed(sums, a, b).view(np.int64)),
                     pa.array(hashed(prefix(data, _OTHER), a, b).view(np.int64))],
                    names=["doc_id", "text_id", "chunk", "start", "end", "n_words", "digest", "check"])

    return _texts(docs, id_col, text_col).select("doc_id", "text_id", "text").mapInArrow(
        run, "doc_id long, text_id long, chunk int, start int, end int, n_words int, digest long, check long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _order() -> Column:
    return F.coalesce("doc_id", F.lit(_LAST)).alias("o")


def _around(rows: DataFrame) -> DataFrame:
    """Of the ``wanted`` stretches (c0, c1) of chunks of every (o, t, text):
    limits in code points, number of the first word, words, and the hashes of up to ``EDGE`` words
    before and after, nearest first, with the code points where they begin
    and end."""
    def lists(parts, kind):
        cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(parts).astype(kind)))

    def run(batches):
        for batch in batches:
            wanted = batch.column(3)
            cut = wanted.offsets.to_numpy()
            c0, c1 = (wanted.values.field(i).to_numpy() for i in (0, 1))
            for first, (start, end, row), (begin, last), _, sums, _, points, bounds in _cut(batch.column(2)):
                of, words = row[begin], hashed(sums, start, end).astype(np.uint32).view(np.int32)
                for r in np.unique(of):
                    at, base = np.searchsorted(of, r), points[bounds[r]]
                    low, high = np.searchsorted(row, [r, r + 1])
                    k = slice(cut[first + r], cut[first + r + 1])
                    a, b = begin[at + c0[k]], last[at + c1[k]] + 1
                    if not len(a):
                        continue
                    before = [np.arange(x - 1, max(low, x - EDGE) - 1, -1) for x in a]
                    after = [np.arange(x, min(high, x + EDGE)) for x in b]
                    whose = pa.array(np.full(len(a), first + r))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(whose), batch.column(1).take(whose), pa.array(c0[k]), pa.array(c1[k]),
                         pa.array((points[start[a]] - base).astype(np.int32)), pa.array((points[end[b - 1]] - base).astype(np.int32)),
                         pa.array(a - low), pa.array((b - a).astype(np.int64)), lists([words[x] for x in before], np.int32), lists([words[x] for x in after], np.int32),
                         lists([points[start[x]] - base for x in before], np.int32), lists([points[end[x]] - base for x in after], np.int32)],
                        names=["o", "t", "c0", "c1", "start", "end", "word", "n_words", "before", "after", "starts", "ends"])

    return rows.select("o", "t", "text", "wanted").mapInArrow(
        run, "o long, t long, c0 int, c1 int, start int, end int, word long, n_words long, before array<int>, after array<int>, "
             "starts array<int>, ends array<int>")


def _runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(o, t, c0, c1, n_chunks, n_places, first, head, tail, own): stretches of
    neighbouring chunks that occur more than once; ``head`` and ``tail`` have
    the places of the outermost chunks, ``own`` says that the stretch is the
    first place of its chunks."""
    found = chunked(docs, id_col, text_col).select(_order(), F.col("text_id").alias("t"), F.col("chunk").alias("c"), "digest", "check")
    place, both = F.struct("o", "t", "c"), ["digest", "check"]
    shared = written(found.groupBy(*both).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi")).filter("n > 1"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    # each has a thousandth of all repeated places, so there are at most 1,000
    hot = F.broadcast(shared.filter(F.col("n") * 1000 > total).filter(F.col("n") > SALTS * RUNS // 100).select(*both, F.lit(True).alias("hot")))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("o", "t", "c"), F.lit(SALTS)).cast("int")).otherwise(0)
    placed = (found.join(hot, both, "left").withColumn("salt", salt).drop("hot")
              .join(shared.join(hot, both, "left").withColumn("salt", F.explode(parts)).drop("hot"), [*both, "salt"]))
    # identical rows hold the same places: merged before they move
    placed = placed.groupBy("o", "t", "c").agg(F.min("n").alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
    placed = placed.withColumn("own", F.col("lo") == place)
    order = Window.partitionBy("o", "t", "own").orderBy("c")
    edge = F.struct("lo", "hi", "n")
    return placed.withColumn("island", F.col("c") - F.row_number().over(order)).groupBy("o", "t", "own", "island").agg(
        F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("n_chunks"), F.max("n").alias("n_places"),
        F.mode("lo.o", True).alias("first"), F.min_by(edge, "c").alias("head"), F.max_by(edge, "c").alias("tail"))


def _grown(runs: DataFrame, around: DataFrame) -> DataFrame:
    """(o, t, c0, c1, side, words): by how many words a run grows at a side."""
    def edges(side: str, at: str, words: str) -> DataFrame:
        return runs.filter(F.size(words) > 0).select("o", "t", "c0", "c1", F.lit(side).alias("side"), F.col(words).alias("x"), F.col(f"{at}.n").alias("n"), F.explode(
            F.array_distinct(F.array(f"{at}.lo", f"{at}.hi"))).alias("p"), F.struct("o", "t", F.col("c0" if at == "head" else "c1").alias("c")).alias("me")
        ).filter("p <> me").drop("me")

    many = edges("before", "head", "before").union(edges("after", "tail", "after")).withColumn(
        "salt", F.pmod(F.xxhash64("o", "t", "c0"), F.ceil(F.col("n") / RUNS)).cast("int"))
    places = many.groupBy("p", "side").agg(F.max("n").alias("n")).select(
        F.col("p.o").alias("o"), F.col("p.t").alias("t"), F.col("p.c").alias("c0"), F.col("p.c").alias("c1"), "p", "side", "n")
    held = places.join(around, ["o", "t", "c0", "c1"]).select("p", "side", F.when(F.col("side") == "before", F.col("before")).otherwise(F.col("after")).alias("y"), F.explode(
        F.sequence(F.lit(0), F.ceil(F.col("n") / RUNS).cast("int") - 1)).alias("salt"))
    apart = F.array_position(F.zip_with("x", "y", lambda a, b: F.coalesce(a == b, F.lit(False))), False)
    words = F.when(apart == 0, F.size("x")).otherwise(apart - 1)
    return many.join(held, ["p", "side", "salt"]).groupBy("o", "t", "c0", "c1", "side").agg(F.max(words).cast("int").alias("words"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, start, end, n_words, n_chunks, first_doc_id, n_places, removable):
    the repeated passages of every document. ``first_doc_id`` is the first
    document of most of its chunks, ``n_chunks`` the whole chunks in it,
    ``n_places`` the most places of one of them; ``removable`` is false for the first place itself."""
    ship(docs.sparkSession)
    runs = written(_runs(docs, id_col, text_col))
    # the runs and the places that their ends are compared with, once per text
    stretch = lambda c0, c1: F.struct(F.col(c0).alias("c0"), F.col(c1).alias("c1")).alias("s")
    wanted = runs.select("o", "t", stretch("c0", "c1"))
    for p in ("head.lo", "head.hi", "tail.lo", "tail.hi"):
        wanted = wanted.union(runs.select(f"{p}.o", f"{p}.t", stretch(f"{p}.c", f"{p}.c")))
    texts = _texts(docs, id_col, text_col).select(_order(), F.col("text_id").alias("t"), "text")
    wanted = wanted.groupBy("o", "t").agg(F.collect_set("s").alias("wanted"))
    around = written(_around(texts.join(wanted, ["o", "t"])).dropDuplicates(["o", "t", "c0", "c1"]))
    key = ["o", "t", "c0", "c1"]
    whole = runs.join(around, key)
    grown = _grown(whole, around).groupBy(*key).agg(*[F.max(F.when(F.col("side") == s, F.col("words"))).alias(f"n_{s}") for s in ("before", "after")])
    copies = texts.groupBy("o", "t").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    n, m = (F.coalesce(f"n_{s}", F.lit(0)) for s in ("before", "after"))
    limits = whole.join(grown, key, "left").select(
        "o", "t", F.when(n > 0, F.get("starts", n - 1)).otherwise(F.col("start")).alias("start"), F.when(m > 0, F.get("ends", m - 1)).otherwise(F.col("end")).alias("end"),
        (F.col("n_words") + n + m).alias("n_words"), "n_chunks", "first", "n_places", "own",
        (F.col("word") - n).alias("w0"), (F.col("word") + F.col("n_words") + m).alias("w1")).filter(F.col("n_words") >= least_words)
    # a first place goes with the copies of earlier ones that it lies in, unless enough words are left between them
    so_far = lambda *by: Window.partitionBy("o", "t").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    copied = lambda c: F.when(~F.col("own"), F.col(c))
    out = limits.withColumn("low", F.max(copied("w1")).over(so_far("w0", "own"))).withColumn("high", F.min(copied("w0")).over(so_far(F.col("w1").desc(), "own")))
    out = out.filter(~F.col("own") | (F.coalesce(F.least("w1", "high"), "w1") - F.coalesce(F.greatest("w0", "low"), "w0") >= least_words))
    # of identical rows the first keeps its text
    out = out.join(copies, ["o", "t"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
    named = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return out.select(
        named("o").alias("doc_id"), "start", "end", "n_words", "n_chunks", named("first").alias("first_doc_id"), "n_places",
        (~F.col("own") | (F.col("copy") > 1)).alias("removable"))
