"""Exact distinct counts by mergeable words of bits.

A group's distinct ids are kept as words: bit ``_pos & 63`` of word
``_pos >> 6``, merged by OR. Rows whose id occurs once in its stored table
(``_once``) need no bit and are counted. Words are built by plain hash
aggregation before the exchange, so what crosses it is one row per group and
word (up to 64 ids) and one per group and task for the others; a hot id is
one bit wherever it occurs, a NULL id none. Words of finer groups OR to those
of coarser ones (``merged``), so totals come from the values' words without
another scan.

64-bit words rather than 4 KB bitmaps: they stay in the generated hash
aggregation, and a value that few ids hold costs a few bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.sources.positions import ONCE, POS

WORD = "_word"


def word() -> Column:
    """The word a row's bit belongs to; NULL for rows that are counted."""
    return F.when(~F.col(ONCE), F.shiftright(POS, 6))


def bit(cond: Column | None = None) -> Column:
    own = F.expr(f"shiftleft(1L, CAST({POS} & 63 AS INT))")
    take = ~F.col(ONCE) & F.col(POS).isNotNull()
    return F.when(take if cond is None else take & cond, own)


def words(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """``(*keys, _word, _n, _bits)`` of rows that carry ``_pos`` and ``_once``."""
    return rows.groupBy(*keys, word().alias(WORD)).agg(F.count_if(F.col(ONCE)).alias("_n"), F.bit_or(bit()).alias("_bits"))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Words of coarser groups. Every counted row must be in one finer group only."""
    return parts.groupBy(*keys, WORD).agg(F.sum("_n").alias("_n"), F.bit_or("_bits").alias("_bits"))


def counted(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``(*keys, name)``: the number of distinct ids. A group that only NULL
    ids hold stays, with 0."""
    return parts.groupBy(*keys).agg(F.sum(F.col("_n") + F.coalesce(F.bit_count("_bits"), F.lit(0))).cast("bigint").alias(name))


def flagged_ids(rows: DataFrame, keys: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """``(*keys, *flags)``: for every flag the distinct ids of its rows, all
    in one aggregation: a row per group and word crosses the exchange."""
    aggs, sums = [], []
    for i, (name, flag) in enumerate(flags.items()):
        aggs += [F.count_if(F.col(ONCE) & flag).alias(f"_n_{i}"), F.bit_or(bit(flag)).alias(f"_bits_{i}")]
        sums.append(F.sum(F.col(f"_n_{i}") + F.coalesce(F.bit_count(f"_bits_{i}"), F.lit(0))).cast("bigint").alias(name))
    return rows.groupBy(*keys, word().alias(WORD)).agg(*aggs).groupBy(*keys).agg(*sums)


def distinct_ids(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``COUNT(DISTINCT id)`` by ``keys``."""
    return counted(words(rows, keys), keys, name)
