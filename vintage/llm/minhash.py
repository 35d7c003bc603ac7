r"""MinHash near-duplicates through a multi-index Hamming join.

A document's set of word shingles gives ``CHUNKS`` x ``SYMBOLS`` minimum
hashes, each cut to ``BITS`` bits: a signature of 40 symbols, kept as 8
chunks of 60 bits. Two signatures are at distance d when d symbols differ.

Pigeonhole: at a distance of at most ``CHUNKS * (ERRORS + 1) - 1`` = 15 some
chunk differs in at most one symbol. So each chunk is entered under the 5
keys that leave one symbol out; two signatures share a key exactly when
some chunk has at most one error, and all pairs within distance 15 meet. At
the similarity of 0.8 the mean distance is 8; such a pair shares no key with
a chance of 2 in 100,000, and pairs above it less.

Equal sets are one class first, so copies never meet as pairs. Within a key
all classes are first compared with one of them only, the one that meets
most others under all its keys; what that confirms is contracted to components, and only classes of one key that
are still in different components are compared pairwise (in large keys block by block, without making the pairs). A group of near
copies, however large, is thus confirmed along a star, and no link between
different components is lost. Pairs whose signatures differ in more than
``FAR`` symbols are no candidates (at 0.8 a chance of 2 in 100,000);
the others are confirmed on the full shingle sets of their texts.

Defined results: null text and text without words have an empty set, link
with nothing and are their own component; rows with the same id are one
node; equal sets are linked; an empty table gives an empty result; fewer
words than a shingle make the whole sequence the only shingle. Rows without an
id link like any other and are named inside by a 64-bit hash of their text (so equal
texts are one node; a hash equal to another row's name would merge two
nodes, at a thousand million such rows with a chance of 3 in 100); as they have no id, their component is the
smallest id that they reach, or null where none has one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm import graph
from vintage.llm.common import dropped, few_others, ship, written
from vintage.llm.textbatch import U, grams, hashed, mix, prefix, slices, spans

CHUNKS, SYMBOLS, BITS, ERRORS = 8, 5, 12, 1
#: Signature distance up to which all pairs are guaranteed to meet.
GUARANTEED = CHUNKS * (ERRORS + 1) - 1
FAR = 19
#: Keys of more classes than this are compared in blocks of about ``BLOCK``.
FEW = 48
BLOCK = 400
#: Rows of a minimum taken at once.
_ROWS = 8192

_rng = np.random.default_rng(20_240_607)
_SALT = _rng.integers(0, 1 << 63, CHUNKS * SYMBOLS, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, CHUNKS * SYMBOLS, dtype=np.uint64) * U(2) + U(1)


def shingle_sets(column: pa.Array, shingle: int):
    """(row, sorted distinct shingle hashes) of every row of ``column``."""
    for first, data, bounds in slices(column):
        start, end, row = spans(data, bounds)
        words = hashed(prefix(data), start, end)
        rows = len(bounds) - 1
        h, of = grams(words, row, shingle, rows)
        cut = np.searchsorted(of, np.arange(rows + 1))
        word_cut = np.searchsorted(row, np.arange(rows + 1))
        for r in range(rows):
            n = word_cut[r + 1] - word_cut[r]
            if n >= shingle:
                yield first + r, np.unique(h[cut[r]:cut[r + 1]])
            elif n:
                yield first + r, grams(words[word_cut[r]:word_cut[r + 1]], np.zeros(n, np.int64), int(n), 1)[0]
            else:
                yield first + r, np.zeros(0, U)


def _signature(s: np.ndarray) -> np.ndarray:
    low = np.full(CHUNKS * SYMBOLS, U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(s), _ROWS):
        low = np.minimum(low, ((s[at:at + _ROWS, None] ^ _SALT) * _ODD).min(axis=0))
    symbols = (mix(low) >> U(64 - BITS)).reshape(CHUNKS, SYMBOLS)
    return (symbols << (U(BITS) * np.arange(SYMBOLS, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


_SIG = [f"c{i}" for i in range(CHUNKS)]
#: Bits of a key below its slot.
_SLOT = BITS * (SYMBOLS - 1)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2) -> DataFrame:
    """(doc_id, name, n_shingles, d1, d2, c0..c7): the id and what stands for it
    inside, set size, two digests of the set (null when it is empty) and the
    signature's chunks."""
    def run(batches):
        for batch in batches:
            column = batch.column(2)
            if not len(column):
                continue
            n = np.zeros(len(column), np.int64)
            out = np.zeros((2 + CHUNKS, len(column)), np.uint64)
            for r, s in shingle_sets(column, shingle):
                n[r] = len(s)
                if len(s):
                    out[0, r], out[1, r] = mix(s).sum(), mix(s ^ U(0xA5A5A5A5DEADBEEF)).sum()
                    out[2:, r] = _signature(s)
            empty = n == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), *[pa.array(x.view(np.int64), mask=empty) for x in out]],
                names=["doc_id", "name", "n_shingles", "d1", "d2", *_SIG])

    schema = "doc_id long, name long, n_shingles long, " + ", ".join(f"{c} long" for c in ("d1", "d2", *_SIG))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _name(id_col, text_col).alias("name"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def _name(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col))


def _keys(classes: DataFrame) -> DataFrame:
    """(key, node): every chunk under the keys that leave one symbol out. A key
    is one number: the place left out (its slot) above ``_SLOT`` bits that hold
    the other symbols of the chunk."""
    def key(c: int, v: int) -> Column:
        low = F.col(_SIG[c]).bitwiseAND(F.lit((1 << (BITS * v)) - 1))
        high = F.shiftleft(F.shiftright(F.col(_SIG[c]), BITS * (v + 1)), BITS * v)
        return high.bitwiseOR(low).bitwiseOR(F.lit((c * SYMBOLS + v) << _SLOT))

    return classes.select(F.explode(F.array(*[key(c, v) for c in range(CHUNKS) for v in range(SYMBOLS)])).alias("key"), "node")


def _mixed(members: DataFrame, value: str) -> DataFrame:
    """Members of the keys that hold two or more of ``value``, with the number of
    members (n_met). Rows move once, to their key; a key's rows are read in turn."""
    key = Window.partitionBy("key")
    lo, hi = F.min(value).over(key), F.max(value).over(key)
    return (members.withColumns({"lo": lo, "hi": hi, "n_met": F.count(F.lit(1)).over(key)})
            .filter("lo < hi").drop("lo", "hi"))


def _distance(x: str, y: str) -> Column:
    """Symbols that differ."""
    total = F.lit(0)
    for c in _SIG:
        d = F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))
        for v in range(SYMBOLS):
            total = total + (d.bitwiseAND(F.lit(((1 << BITS) - 1) << (BITS * v))) != 0).cast("int")
    return total


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures and set sizes allow the similarity."""
    sides = classes.select("node", F.struct("n_shingles", *_SIG).alias("s"))
    both = (pairs.join(sides.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
            .join(sides.select(F.col("node").alias("b"), F.col("s").alias("y")), "b"))
    small, large = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    return both.filter((_distance("x", "y") <= FAR) & (small * 100 >= large * percent)).select("a", "b").distinct()


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that have 100 * intersection >= percent * union on the
    full sets of their texts (node, text). Copies of one text under one id
    count once."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = shingle_sets(batch.column(2), shingle), shingle_sets(batch.column(3), shingle)
            keep = []
            for (_, x), (_, y) in zip(left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _crowded(members: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between different components inside large keys, found
    without making their pairs. A key's members are split into blocks; a block
    is held with its shingle sets while every member of a later block streams
    by. A pair is looked at under the first key that it shares, and only
    links that join two components of the block are returned."""
    blocks = F.ceil(F.col("n_met") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    visits = F.when(block + 1 < blocks, F.sequence(block + 1, blocks - 1)).otherwise(F.array().cast("array<int>"))
    places = members.withColumn("slot", F.shiftright("key", _SLOT).cast("int")).withColumn("place", F.explode(F.concat(F.array(F.struct(block.alias("block"), F.lit(0).alias("visits"))), F.transform(
        visits, lambda b: F.struct(b.alias("block"), F.lit(1).alias("visits"))))))
    key = ["slot", "key", "block"]
    rows = (places.select("slot", "key", "place.block", "place.visits", "node", "component")
            .join(few_others(classes, members, "node").select("node", *_SIG), "node")
            .join(few_others(texts, members, "node"), "node"))
    rows = rows.select(*key, "visits", "node", "component", *_SIG, "text").repartition(*key).sortWithinPartitions(*key, "visits", "node")

    def run(batches):
        block, home = None, None
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
            visits = batch.column(3).to_pylist()
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or visits[i] != visits[i - 1] or i % BLOCK == 0], len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != block:
                    block, home = keys[a], None
                part = batch.slice(a, b - a)
                node, component = (part.column(i).to_numpy().copy() for i in (4, 5))
                chunks = np.stack([part.column(6 + c).to_numpy() for c in range(CHUNKS)], axis=1).view(np.uint64)
                symbols = ((chunks[:, :, None] >> (U(BITS) * np.arange(SYMBOLS, dtype=np.uint64))) & U((1 << BITS) - 1)).astype(np.uint16)
                sets = [s for _, s in shingle_sets(part.column(6 + CHUNKS), shingle)]
                now = (node, component, symbols, sets, np.array([len(s) for s in sets]))
                linked = []
                if home is not None:
                    linked += _compared(home, now, block[0], percent)
                if not visits[a]:
                    linked += _compared(now, now, block[0], percent)
                    home = now if home is None else tuple(x + y if isinstance(x, list) else np.concatenate([x, y]) for x, y in zip(home, now))
                if linked:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in linked]), pa.array([y for _, y in linked])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _compared(x: tuple, y: tuple, slot: int, percent: int) -> list[tuple[int, int]]:
    """Links between rows of ``x`` and of ``y`` that join different components."""
    differ = (x[2].reshape(len(x[0]), 1, -1) != y[2].reshape(1, len(y[0]), -1)).sum(axis=2)
    small, large = np.minimum.outer(x[4], y[4]), np.maximum.outer(x[4], y[4])
    i, j = np.nonzero((differ <= FAR) & (small * 100 >= large * percent) & (x[1][:, None] != y[1][None, :]) & (x[0][:, None] != y[0][None, :]))
    if not len(i):
        return []
    errors = x[2][i] != y[2][j]
    shares = errors.sum(axis=2) <= ERRORS
    chunk = shares.argmax(axis=1)
    first = chunk * SYMBOLS + errors[np.arange(len(i)), chunk].argmax(axis=1)
    keep = shares.any(axis=1) & (first == slot)
    parent: dict[int, int] = {}

    def find(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for p, q in zip(i[keep].tolist(), j[keep].tolist()):
        a, b = find(int(x[1][p])), find(int(y[1][q]))
        if a != b:
            both = len(np.intersect1d(x[3][p], y[3][q], assume_unique=True))
            if 100 * both >= percent * (x[4][p] + y[4][q] - both):
                parent[max(a, b)] = min(a, b)
                out.append((int(x[0][p]), int(y[0][q])))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    ship(docs.sparkSession)
    rows = written(signatures(docs, id_col, text_col, shingle))
    classes = written(rows.filter("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("id"), F.min("name").alias("node"), F.max("n_shingles").alias("n_shingles"), *[F.max(c).alias(c) for c in _SIG]))
    texts = docs.select(_name(id_col, text_col).alias("node"), F.col(text_col).alias("text"))
    pairs_met = written(_mixed(_keys(classes), "node"))
    # the text that meets most others under all its keys heads each of them:
    # of a text and its altered copies that is the text they all come from
    popular = pairs_met.groupBy("node").agg(F.struct(F.sum("n_met").alias("n_met"), (-F.col("node")).alias("id")).alias("rank"))
    ranked = pairs_met.select("key", "node").join(popular, "node")
    heads = ranked.groupBy("key").agg((-F.max("rank")["id"]).alias("head"))
    met = written(pairs_met.select("key", "node").join(heads, "key"))
    dropped(pairs_met)

    star = written(_close(met.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(),
                          few_others(classes, met, "node"), percent))
    links = written(confirm(star, _needed(texts, star), shingle, percent))
    first = written(graph.components(links))

    placed = met.join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    loose = written(_mixed(placed, "component"))
    dropped(met, first)
    crowd = _crowded(loose.filter(F.col("n_met") > FEW), classes, texts, shingle, percent)
    rest = loose.filter(F.col("n_met") <= FEW)
    other = rest.select("key", F.col("node").alias("b"), F.col("component").alias("b_component"))
    pairs = (rest.join(other, "key").filter("node < b and component <> b_component")
             .select(F.col("node").alias("a"), "b").distinct())
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    late = written(_close(pairs, few_others(classes, loose, "node"), percent).join(tried, ["a", "b"], "left_anti"))
    dropped(star)
    whole = graph.components(links.union(confirm(late, _needed(texts, late), shingle, percent)).union(crowd))
    dropped(links, late, loose)

    reached = classes.join(whole, "node", "left").select("d1", "d2", "id", F.coalesce("component", "node").alias("component"))
    first = reached.groupBy("component").agg(F.min("id").alias("component_id"))
    named = reached.join(first, "component").select("d1", "d2", "component_id")
    return rows.join(named, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _needed(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of the nodes that occur in ``pairs``, and few others."""
    return few_others(rows, pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
