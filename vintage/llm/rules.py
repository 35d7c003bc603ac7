r"""Quality rules by weak supervision, with DataFrame functions only.

Every rule looks at one measure of a text and votes good (+1), bad (-1) or
abstains (0). Which rules to trust is not set by hand: expectation-
maximisation over all documents' votes estimates each rule's accuracy (the
chance that its vote is right when it votes) and the share of good
documents, and a document's posterior probability of being good, the
accuracy-weighted sum of its votes' log odds, decides. That replaces "keep
what passes every rule".

Votes of all documents are first counted per pattern (at most 3^rules
patterns, however large the corpus), so an iteration is one aggregate over
the pattern table; the model that the driver holds is one number per rule.

The measures are computed inside a row. Windows of five words are compared
by 64-bit hash; only rows that hold a window twice go on to mark positions.

Defined results: null text counts as no words; texts without words fail the
base rule; repeated rows vote each for itself; an empty table gives an empty
result (the model is then its starting point).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import checkpointed, fresh, let, words

N = 5
LEAST_WORDS = 10
REPEATS_PERCENT = 20
ITERATIONS = 20
SETTLED = 1e-4
#: A rule is taken to be right more often than not and never infallible.
ACCURACY = (0.55, 0.99)
PRIOR = (0.5, 0.99)
THRESHOLD = 0.5


def _windows(w: Column) -> Column:
    """64-bit hashes of all five-word windows, in order."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) < N, F.array().cast("array<bigint>")).otherwise(let(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - N), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(N)]))))


def _repeated(placed: Column) -> Column:
    """Positions, ascending, of sorted (hash, position) pairs whose hash has a neighbour."""
    same = lambda k, x: F.coalesce(F.get(placed, k)["h"] == x["h"], F.lit(False))
    return F.sort_array(F.filter(F.transform(placed, lambda x, k: F.when(
        ((k > 0) & same(F.greatest(k - 1, F.lit(0)), x)) | same(k + 1, x), x["i"])), lambda i: i.isNotNull()))


def _covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    total = F.aggregate(let(placed, _repeated), F.struct(F.lit(-N).alias("last"), F.lit(0).alias("n")), lambda s, i: F.struct(
        i.alias("last"), (s["n"] + F.least(F.lit(N), i - s["last"])).alias("n")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(total["n"])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def measured(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the measures added, their names prefixed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, lines, windows = fresh(docs, "w", "lines", "windows")
    df = docs.withColumn(w, words(F.col(text_col))).withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(windows, _windows(F.col(w)))
    measures = {
        "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col(windows)), "n_lines": F.size(lines),
        "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
        "n_letters": F.length(F.regexp_replace(text, r"[^\p{L}]+", "")),
    }
    return df.select(*docs.columns, *[m.cast("long").alias(prefix + n) for n, m in measures.items()])


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < LEAST_WORDS) | (r * 100 > n * REPEATS_PERCENT)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(prefix: str = "") -> dict[str, Column]:
    """The rules: bad beyond one bound, good within another, else silent."""
    c = lambda name: F.col(prefix + name)
    n, lines, letters = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1)), F.greatest(c("n_letters"), F.lit(1))
    mean = c("word_chars") / n
    return {
        "length": _vote(c("n_words") >= 30, c("n_words") < LEAST_WORDS),
        "word_length": _vote((mean >= 3) & (mean <= 9), (mean < 2.5) | (mean > 14)),
        "symbols": _vote(c("n_symbols") * 100 <= n * 2, c("n_symbols") * 10 > n),
        "symbol_share": _vote(c("n_symbols") * 1000 <= c("word_chars"), c("n_symbols") * 100 > c("word_chars") * 3),
        "upper_case": _vote(c("n_upper") * 10 <= letters, c("n_upper") * 10 > letters * 4),
        "letters": _vote(c("n_letters") * 100 >= c("word_chars") * 85, c("n_letters") * 100 < c("word_chars") * 65),
        "dup_lines": _vote(c("n_dup_lines") * 50 <= lines, c("n_dup_lines") * 10 > lines * 3),
        "repeats": _vote(c("n_repeat_words") * 50 <= n, c("n_repeat_words") * 10 > n),
    }


def _clip(x: float, bounds: tuple[float, float]) -> float:
    return min(max(x, bounds[0]), bounds[1])


def posterior(rules: list[Column], accuracy: list[float], prior: float) -> Column:
    """Probability of good, given the votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for vote, a in zip(rules, accuracy):
        odds = odds + vote * math.log(a / (1 - a))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(voted: DataFrame, names: list[str], iterations: int = ITERATIONS) -> tuple[list[float], float]:
    """(accuracy per rule, share of good) by expectation-maximisation."""
    # at most 3 ** rules rows: one partition, so an iteration is one small task
    patterns = checkpointed(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n_docs")).coalesce(1))
    accuracy, prior = [0.8] * len(names), 0.8
    cols = [F.col(x) for x in names]
    for _ in range(iterations):
        p, n = posterior(cols, accuracy, prior), F.col("n_docs")
        sums = patterns.select("*", p.alias("p_good")).agg(
            F.sum(n * F.col("p_good")).alias("good"), F.sum(n).alias("n"),
            *[F.sum(F.when(v == 1, n * F.col("p_good")).when(v == -1, n * (1 - F.col("p_good")))).alias(f"r{i}")
              for i, v in enumerate(cols)],
            *[F.sum(F.when(v != 0, n)).alias(f"n{i}") for i, v in enumerate(cols)]).first()
        if not sums["n"]:
            break
        # one imagined vote of each kind keeps a rule that never votes defined
        before = accuracy
        accuracy = [_clip(((sums[f"r{i}"] or 0) + 0.8) / ((sums[f"n{i}"] or 0) + 1), ACCURACY) for i in range(len(cols))]
        prior = _clip(sums["good"] / sums["n"], PRIOR)
        moved = max(abs(x - y) for x, y in zip(accuracy, before))
        if moved < SETTLED:
            break
    return accuracy, prior


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with struct ``quality``
    (or a fresh name) added: the measures, base_failed, p_good and kept.

    Measures are written once to the shared folder, without the texts when
    ``keep`` leaves them out, so that fitting and judging read them there."""
    keep = docs.columns if keep is None else keep
    have, prefix = {c.lower() for c in docs.columns}, "m_"
    while any(prefix + m in have for m in MEASURES):
        prefix = "_" + prefix
    rows = measured(docs.select(*keep, *([] if text_col in keep else [text_col])), text_col, prefix).select(
        *keep, *[prefix + m for m in MEASURES])
    if text_col not in keep:
        rows = checkpointed(rows)
    rules = votes(prefix)
    accuracy, prior = fit(rows.select(*[v.alias(k) for k, v in rules.items()]), list(rules))
    p = posterior(list(rules.values()), accuracy, prior)
    name, = fresh(docs, "quality")
    return rows.select(*keep, F.struct(
        *[F.col(prefix + m).alias(m) for m in MEASURES], base_failed(prefix).alias("base_failed"), p.alias("p_good"),
        (~base_failed(prefix) & (p >= THRESHOLD)).alias("kept")).alias(name))
