"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features are the presence of word unigrams, bigrams and skip-grams (two
words with one or two words between them) and of word beginnings,
lower-cased, hashed to ``2 ** BITS`` coordinates. Follow-the-regularised-
leader learns on line: every coordinate has its own learning rate, from the
squares of its own gradients, and the L1 term keeps a coordinate at exactly
zero until its evidence outweighs it, so the model that is broadcast holds
only the few coordinates that matter (at most ``2 ** BITS`` in any case).

Learning reads at most ``MAX_TRAIN`` labelled documents (all of them if
there are fewer), those with the smallest hash of their id; this bound is a
parameter. Scoring reads every whole text in an Arrow map stage: no
shuffle, and only features with a weight are ever sorted or counted.

Defined results: null text is an empty text; a text without known features
gets the score of the bias; labels that are null are left out of learning;
an empty label table gives a model that scores 0.5; repeated rows are scored
each for itself; repeated labels of one document are learnt from once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import one_row
from vintage.llm.textbatch import PUNCT, U, hashed, mix, prefix, slices, spans

BITS = 20
MAX_TRAIN = 12000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.1
#: Distance of the two words of a feature; 1 is a bigram, more a skip-gram.
GAPS = (1, 2, 3)
#: Bytes of a word's beginning that are a feature too, so that inflected
#: forms of one stem share their evidence.
STEMS = (4, 5)


def features(column: pa.Array, bits: int = BITS, known: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct coordinates) of every row that has any; with ``known``
    (a mask over coordinates) only those."""
    shift = U(64 - bits)
    for first, data, bounds in slices(column):
        start, end, row = spans(data, bounds, PUNCT)
        sums = prefix(data)
        words = hashed(sums, start, end)
        found, of = [words >> shift], [row]
        for size in STEMS:
            longer = end - start > size
            found.append(mix(hashed(sums, start[longer], start[longer] + size) + U(size)) >> shift)
            of.append(row[longer])
        for k, gap in enumerate(GAPS):
            pair = mix(words[:-gap] * U(0x9FB21C651E98DF25) + words[gap:] + U(k + 1)) if len(words) > gap else words[:0]
            inside = row[:-gap] == row[gap:] if len(words) > gap else np.zeros(0, bool)
            found.append(pair[inside] >> shift)
            of.append(row[:-gap][inside] if len(words) > gap else row[:0])
        f, r = np.concatenate(found).astype(np.int64), np.concatenate(of)
        if known is not None:
            keep = known[f]
            f, r = f[keep], r[keep]
        both = np.unique((r << bits) | f)
        r, f = both >> bits, both & ((1 << bits) - 1)
        cut = np.flatnonzero(np.diff(r, prepend=-1))
        for a, b in zip(cut, [*cut[1:], len(r)]):
            yield first + int(r[a]), f[a:b]


class Ftrl:
    """Per-coordinate FTRL-proximal state; the bias is the last coordinate."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label)
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) learnt from the ``max_train`` labelled ids of
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
        model, positive = Ftrl(1 << bits), sum(x[1] for x in rows)
        # both classes weigh alike when one is rare
        up = min(10.0, max(1.0, (len(rows) - positive) / max(1, positive)))
        for epoch in range(EPOCHS):
            for k in np.random.default_rng(epoch).permutation(len(rows)):
                model.learn(rows[k][2], rows[k][1], up ** 0.5 if rows[k][1] else 1.0)
        every = model.weights(np.arange(len(model.z)))
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(every[at])], names=["at", "w"])

    found = sample.mapInArrow(extract, "f binary, label int, rank long").repartition(1).mapInArrow(learn, "at long, w double").collect()
    at = np.array([r["at"] for r in found], np.int64)
    w = np.array([r["w"] for r in found])
    size = 1 << bits
    return at[at < size], w[at < size], float(w[at == size].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", score_col: str = "score",
          bits: int = BITS) -> DataFrame:
    """``docs`` with ``text_col`` replaced by the probability of toxicity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        at, w, bias = shared.value
        known, weight = np.zeros(1 << bits, bool), np.zeros(1 << bits)
        known[at], weight[at] = True, w
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            total = np.full(batch.num_rows, bias)
            for r, f in features(batch.column(k), bits, known):
                total[r] += weight[f].sum()
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            names = [n for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(p)],
                                             names=[*names, score_col])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col] + [f"`{score_col}` double"])
    return docs.mapInArrow(run, schema)
