"""Mixing sources to target weights, with DataFrame functions only.

A source's documents are ordered by a hash-random key; the order is cut
into ``BUCKETS`` key ranges per source, so that a source holding a third of
all rows is sorted and summed by many tasks. Sums per (source, range) and
their running totals give every range its offset; a running sum inside the
range then gives each document its exact place in the source's order, and
the source's budget is cut there: whole passes first, then the documents
before the cut once more, the one at the cut with as many of its words as
the budget still holds.

Targets: sources in code-point order (null last) weigh ``WEIGHTS`` in turn
and share ``SHARE`` of all words; none gets more than ``MOST`` times its own
words, and what is above that goes to the others by weight (the level at
which nothing is above any more, found from one row per source).

Defined results: null text has size 0; null source is a source of its own;
documents of size 0 take 0; repeated rows are mixed each for itself; an
empty table gives an empty result; keys depend on the id only, so reruns
agree (rows with equal id are ordered by size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.common import WORD, checkpointed, fresh

#: Fixed values of the mix: weights in turn, share of all words, passes at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Key ranges per source (16 to the number of hexadecimal digits).
DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, size) rows -> (source, source_size, target double). The
    windows without a partition hold one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("rank", rank)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("total", F.sum("cap").over(whole) * (share / most))
    # the level if all sources before this one are at their cap
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("cap_rank", "level"))
    per = per.withColumn("cap_rank", F.row_number().over(order))
    per = per.withColumn("level", F.min(below).over(whole)["level"])
    return per.select("source", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        carry: bool = False, seed: str = "mix", weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        digits: int = DIGITS) -> DataFrame:
    """(doc_id, size, source_size, target, taken); with ``carry`` also the
    given columns of ``docs`` as struct ``row``, for :func:`emit`."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key"),
                       *([F.struct(*docs.columns).alias("row")] if carry else []))
    # a source as a string that is never null and a flag: the sums inside a range
    # and the join with its offset then share one move of the rows
    base = base.withColumns({"cell": F.substring("key", 1, digits), "no_source": F.col("source").isNull(),
                             "some_source": F.coalesce(F.col("source").cast("string"), F.lit(""))})
    # without texts the table is a few dozen bytes a row: keep it, so that
    # words are counted once
    slim = base.drop("row") if carry else (base := checkpointed(base))
    group = ["some_source", "no_source", "cell"]
    cells = slim.groupBy("source", *group).agg(F.sum("size").alias("cell_size"))
    goal = targets(cells.select("source", F.col("cell_size").alias("size")), weights, share, most)
    in_order = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("ahead", F.sum("cell_size").over(in_order) - F.col("cell_size"))
    plan = cells.join(goal, cells["source"].eqNullSafe(goal["source"])).select(*group, "ahead", "source_size", "target")
    placed = base.withColumn("within", F.sum("size").over(
        Window.partitionBy(*group).orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    placed = placed.join(plan, group)
    words = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    rest = words - passes * F.col("source_size")
    ahead = F.col("ahead") + F.col("within")
    taken = passes * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest - ahead))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
                         *(["row"] if carry else []))


def emit(mixed: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it
    whole, and the one at the cut once more with only the words taken (its
    text up to the end of the last of them)."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0)).cast("long")
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    copy, row = fresh(mixed, "copy", "row")[0], "row"
    out = mixed.select(row, F.explode(copies).alias(copy))
    text = F.col(f"{row}.`{text_col}`")
    # matches of the words and the white space before them, the first ones of them joined
    start = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)),
                                 F.lit(1), F.greatest(F.col(copy), F.lit(1)).cast("int")), "")
    return out.select(*[F.when(F.col(copy) > 0, start).otherwise(text).alias(c) if c == text_col
                        else F.col(f"{row}.`{c}`").alias(c) for c in columns])
