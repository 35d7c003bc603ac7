"""Quality classifier: Naive Bayes log-count ratios under a linear SVM.

Features are the presence of n-grams of two token streams of a text: its
words (lower-cased, one and two words) and their shapes (one to three). A
shape tells the case, the characters a word is made of, its length class,
its last signs and whether it repeats the word before, so that junk is known
by its form in any language. Every n-gram indicator is scaled by the log
ratio of its smoothed counts in the two classes; a linear hinge-loss model
is then fitted by dual coordinate descent, one document's dual variable
after the other, and interpolated with the mean weight as usual for this
model family. A logistic curve over the training margins makes the margin a
probability.

Fitting reads at most ``MAX_TRAIN`` labelled documents (those with the
smallest hash of their id), ratios included; this bound is a parameter. The
model is bounded by ``2 ** BITS`` coordinates. Scoring reads every whole text
in an Arrow map stage without a shuffle.

Defined results: null text is an empty text; a text without words gets the
score of the bias; labels that are null are left out of fitting; with one
class only, or none, every score is that class's share (0.5 if none);
repeated rows are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import one_row
from vintage.llm.textbatch import U, grams, hashed, mix, prefix, slices, spans

BITS = 18
MAX_TRAIN = 8000
EPOCHS = 12
COST = 1.0
SMOOTH = 1.0
#: Share of the fitted weights against their mean size.
BLEND = 0.9

_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[192:] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_SIGN = np.zeros(256, np.int64)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = 1


def _counts(data: np.ndarray, table: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(table[data])])
    return sums[end] - sums[start]


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One number per word that tells its form."""
    if not len(start):
        return words
    upper, letter, digit, sign = (_counts(data, t, start, end) for t in (_UPPER, _LETTER, _DIGIT, _SIGN))
    first = _UPPER[data[start]]
    case = np.where(upper >= 2, np.where(upper * 2 > letter, 3, 2), first)
    size = np.digitize(end - start, (2, 4, 8, 14, 24))
    last = np.where(_SIGN[data[end - 1]] > 0, data[end - 1].astype(np.int64), 0)
    again = np.concatenate([[0], (words[1:] == words[:-1]).astype(np.int64)])
    shape = (((((case * 8 + size) * 4 + np.minimum(sign, 3)) * 2 + (digit > 0)) * 256 + last) * 2 + again) * 2 + (letter == 0)
    return mix(shape.astype(U) + U(0x51ED270B))


def features(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct coordinates) of every row that has any."""
    shift = U(64 - bits)
    for first, data, bounds in slices(column):
        start, end, row = spans(data, bounds)
        words = hashed(prefix(data), start, end)
        shapes = _shapes(data, start, end, words)
        found = [grams(t, row, n, len(bounds) - 1) for t, most in ((words, 2), (shapes, 3)) for n in range(1, most + 1)]
        f = np.concatenate([mix(h + U(k)) >> shift for k, (h, _) in enumerate(found)]).astype(np.int64)
        both = np.unique((np.concatenate([r for _, r in found]) << bits) | f)
        r, f = both >> bits, both & ((1 << bits) - 1)
        cut = np.flatnonzero(np.diff(r, prepend=-1))
        for a, b in zip(cut, [*cut[1:], len(r)]):
            yield first + int(r[a]), f[a:b]


def fit(rows: list[tuple[np.ndarray, int]], size: int) -> tuple[np.ndarray, float, float, float]:
    """(weights, bias, slope, offset) of the bounded sample ``rows``."""
    labels = np.array([y for _, y in rows], int)
    if len(set(labels.tolist())) < 2:
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        return np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share)))
    counts = np.full((2, size), SMOOTH)
    for f, y in rows:
        counts[y, f] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # rows of unit length, so that long texts weigh like short ones
    scaled = [ratio[f] / max(1e-9, float(np.sqrt((ratio[f] ** 2).sum()))) if len(f) else ratio[f] for f, _ in rows]
    w, dual = np.zeros(size + 1), np.zeros(len(rows))
    share = labels.mean()
    cost = np.where(labels == 1, COST * min(1.0, (1 - share) / share), COST * min(1.0, share / (1 - share))) * 10
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            f, x, y = rows[k][0], scaled[k], 2 * rows[k][1] - 1
            gradient = y * (w[f] @ x + w[size]) - 1
            step = min(max(dual[k] - gradient / (float(x @ x) + 1), 0.0), cost[k]) - dual[k]
            if step:
                dual[k] += step
                w[f] += step * y * x
                w[size] += step * y
    mean = np.abs(w[:size]).mean()
    weights = BLEND * w[:size] + (1 - BLEND) * mean * np.sign(w[:size])
    margins = np.array([weights[f] @ x + w[size] for (f, _), x in zip(rows, scaled)])
    slope, offset = _curve(margins, labels)
    return weights * ratio, float(w[size]), slope, offset


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over ``margins`` (Newton's
    method on slightly smoothed labels, both classes weighing alike)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0) * len(labels)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        g, h = weight * (p - goal), weight * p * (1 - p) + 1e-9
        a, b, c = (h * margins ** 2).sum() + 1e-6, (h * margins).sum(), h.sum() + 1e-6
        ga, gb = (g * margins).sum(), g.sum()
        d = a * c - b * b
        if d <= 0:
            break
        slope, offset = slope - 0.7 * (c * ga - b * gb) / d, offset - 0.7 * (a * gb - b * ga) / d
    return float(np.clip(slope, 0.1, 50)), float(np.clip(offset, -20, 20))


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN, bits: int = BITS) -> tuple:
    """(scaled weights, ratios, bias, slope, offset) learnt from the ``max_train`` labelled ids of
    smallest hash, with one text of every id. The texts become features where they are read; one task
    learns from the bounded sample's features."""
    chosen = (labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .withColumn("rank", F.xxhash64("id")).orderBy("rank", "label").limit(max_train))
    texts = one_row(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), chosen, "text")
    sample = texts.join(F.broadcast(chosen), "id").select("text", "label", "rank")

    def extract(batches):
        for batch in batches:
            got = [np.zeros(0, np.int32)] * batch.num_rows
            for r, f in features(batch.column(0), bits):
                got[r] = f.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in got], pa.binary()), batch.column(1), batch.column(2)],
                names=["f", "label", "rank"])

    def learn(batches):
        rows = [(rank, label, np.frombuffer(f, np.int32)) for b in batches
                for f, label, rank in zip(*[b.column(i).to_pylist() for i in range(3)])]
        rows.sort(key=lambda x: (x[0], len(x[2])))
        sample = [(f, y) for _, y, f in rows]
        weights, bias, slope, offset = fit(sample, 1 << bits)
        counts = np.full((2, 1 << bits), SMOOTH)
        for f, y in sample:
            counts[y, f] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        pack = lambda x: x.astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([pack(weights)], pa.binary()), pa.array([pack(ratio)], pa.binary()),
             *[pa.array([float(x)]) for x in (bias, slope, offset)]], names=["w", "ratio", "bias", "slope", "offset"])

    m = sample.mapInArrow(extract, "f binary, label int, rank long").repartition(1).mapInArrow(
        learn, "w binary, ratio binary, bias double, slope double, offset double").first()
    return (bytes(m["w"]), bytes(m["ratio"]), m["bias"], m["slope"], m["offset"]) if m else (
        bytes(4 << bits), bytes(4 << bits), 0.0, 0.0, 0.0)


def score(docs: DataFrame, model: tuple, text_col: str = "text", score_col: str = "score", bits: int = BITS) -> DataFrame:
    """``docs`` with ``text_col`` replaced by the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weight, ratio = (np.frombuffer(x, np.float32).astype(float) for x in shared.value[:2])
        bias, slope, offset = shared.value[2:]
        square = ratio ** 2
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            margin = np.full(batch.num_rows, bias)
            for r, f in features(batch.column(k), bits):
                margin[r] += weight[f].sum() / max(1e-9, float(np.sqrt(square[f].sum())))
            p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            names = [n for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(p)],
                                             names=[*names, score_col])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col] + [f"`{score_col}` double"])
    return docs.mapInArrow(run, schema)
