"""Substring dedup against brute force, and its defined results."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from vintage.llm import chunks
from vintage.llm.textbatch import spans


def _words(rng, n, letters="abcdefgh"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _shared(texts, n):
    """{(document, first word)}: the n-word windows that occur twice or more."""
    places = {}
    for d, words in enumerate(texts):
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i:i + n]), []).append((d, i))
    return {p for found in places.values() if len(found) > 1 for p in found}


def _covered(texts, rows):
    """{(document, word)} inside the reported passages."""
    out = set()
    for r in rows:
        at = 0
        for i, w in enumerate(texts[r.doc_id]):
            if r.start <= at and at + len(w) <= r.end:
                out.add((r.doc_id, i))
            at += len(w) + 1
    return out


def test_random_corpora_against_brute_force(spark):
    """Words of every window of 30 words that occurs twice are reported, and
    nothing outside windows of 4 words that do."""
    wanted = found = extra = 0
    for seed in range(3):
        rng = random.Random(seed)
        pieces = [_words(rng, rng.randint(20, 90)) for _ in range(40)]
        texts = []
        for _ in range(150):
            words = []
            for _ in range(rng.randint(1, 4)):
                piece = rng.choice(pieces)
                cut = rng.randint(0, len(piece) // 3)
                words += _words(rng, rng.randint(0, 40)) + (piece[cut:] if rng.random() < 0.5 else piece)
            texts.append(words)
        rows = chunks.repeated(_frame(spark, [(d, " ".join(w)) for d, w in enumerate(texts)])).collect()
        inside = _covered(texts, rows)
        need = {(d, i + k) for d, i in _shared(texts, 30) for k in range(30)}
        loose = {(d, i + k) for d, i in _shared(texts, 4) for k in range(4)}
        wanted, found, extra = wanted + len(need), found + len(need & inside), extra + len(inside - loose)
    assert found >= 0.99 * wanted and wanted > 10_000
    assert extra <= 0.001 * wanted  # a word beside a passage may be the same by chance


def test_rows_without_an_id_and_clashing_columns(spark):
    rng = random.Random(4)
    passage, other = " ".join(_words(rng, 60)), " ".join(_words(rng, 60))
    lone = " ".join(_words(rng, 60))
    texts = [(7, f"{' '.join(_words(rng, 9))} {passage}"), (None, f"{passage} {' '.join(_words(rng, 9))}"), (None, other), (None, other),
             (5, lone), (None, None), (None, ""), (3, None), (3, " \n")]
    df = _frame(spark, texts)
    for name in ("o", "t", "digest", "CHUNK", "n", "salt", "hot", "wanted"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted([(r.doc_id, r.n_words, r.first_doc_id, r.n_places, r.removable) for r in chunks.repeated(df).collect()], key=str)
    assert got == sorted([(7, 60, 7, 2, False), (None, 60, 7, 2, True), (None, 60, None, 2, False), (None, 60, None, 2, True)], key=str)
    assert chunks.repeated(df.limit(0)).count() == 0


def test_copies_and_a_passage_in_most_texts(spark):
    rng = random.Random(6)
    passage, copy = " ".join(_words(rng, 55)), " ".join(_words(rng, 80))
    rows = [(d, f"{' '.join(_words(rng, 20))} {passage} {' '.join(_words(rng, 20))}") for d in range(6000)]
    rows += [(d, copy) for d in range(6000, 7000)]
    got = chunks.repeated(_frame(spark, rows)).collect()
    assert len(got) == 7000 and {r.doc_id for r in got} == set(range(7000))
    assert all(55 <= r.n_words <= 58 and r.first_doc_id == 0 and r.removable == (r.doc_id > 0) for r in got if r.doc_id < 6000)
    assert all(r.n_words == 80 and r.n_places == 1000 and r.first_doc_id == 6000 for r in got if r.doc_id >= 6000)


def test_insertions_move_chunks_and_nothing_else():
    rng = random.Random(8)
    words = _words(rng, 4000)
    moved = words[:2000] + _words(rng, 3) + words[2000:]

    def cut(w):
        text = " ".join(w).encode()
        data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        start, end, row = spans(data, bounds)
        last = np.flatnonzero(chunks.closing(data, bounds, end, row))
        return {text[start[a]:end[b]] for a, b in zip([0, *(last[:-1] + 1)], last)}
    assert len(cut(words) - cut(moved)) <= 4


def test_a_text_of_20_mb(spark):
    rng = random.Random(9)
    some = _words(rng, 200_000)
    long = " ".join(some[k % 200_000] if k % 977 else f"u{k}" for k in range(3_100_000))
    began = time.time()
    got = chunks.repeated(_frame(spark, [(1, long), (2, long[:9_000_000] + " x " + long[9_000_000:])])).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("w")).first()
    assert len(long) > 19_000_000 and got.w >= 6_190_000 and time.time() - began < 120
