"""Dense positions of ids, made once per stored table.

Exact distinct counts need to know which rows share an id. A stored table
carries that itself: ``_pos``, a position of the row's id (ids of one file
are neighbours, so 64 of them make one word of a bitmap), and ``_once``,
whether no other row has the id. Counting rows of ``_once`` ids needs no ids
at all; of the others, ``operators/distinct.py`` merges words of bits.

A whole number is a position by itself, so a table with such ids is stored
by one exchange of its rows (``laid_out``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

POS, ONCE = "_pos", "_once"
#: Rows of one id above which they are spread over several files.
HOT_ROWS = 100_000


def positioned(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``_pos`` (NULL for a NULL id) and ``_once`` (then false).

    Ids are reduced to one row each before they are ranged and numbered:
    a partition's ids get consecutive numbers, so a position is dense within
    it. A hot id is one row on that side, and its many rows are split by the
    adaptive skew join."""
    ids = df.select(id_col).filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows"))
    numbered = (ids.repartitionByRange(id_col).sortWithinPartitions(id_col)
                .select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias(POS), (F.col("_rows") == 1).alias(ONCE)))
    return (df.join(numbered, F.col(id_col) == F.col("_id"), "left").drop("_id")
            .withColumn(ONCE, F.coalesce(F.col(ONCE), F.lit(False))))


def laid_out(df: DataFrame, id_col: str) -> DataFrame:
    """Rows with ``_pos`` and ``_once``, ranged by position: a task that reads
    a file meets few words. Rows of a hot or NULL id are told apart by their
    content, so they fill as many files as they need."""
    rest = [c for c in df.columns if c != id_col]
    content = F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")
    if not isinstance(df.schema[id_col].dataType, IntegralType):
        return positioned(df, id_col).repartitionByRange(F.col(POS), content)
    # at most one id in ``HOT_ROWS`` rows
    hot = (df.select(id_col).filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows"))
           .filter(F.col("_rows") > HOT_ROWS).select(F.col(id_col).alias("_id"), F.lit(True).alias("_hot")))
    marked = df.join(F.broadcast(hot), F.col(id_col) == F.col("_id"), "left").drop("_id")
    apart = F.col(id_col).isNull() | F.col("_hot").isNotNull()
    # ranged by what the window groups by: no second exchange
    ranged = (marked.withColumn("_apart", apart).withColumn("_part", F.when(apart, content).otherwise(F.lit(0)))
              .repartitionByRange(id_col, "_part"))
    rows = F.count(F.lit(1)).over(Window.partitionBy(id_col, "_part"))
    return ranged.select(*df.columns, F.col(id_col).cast("bigint").alias(POS), (~F.col("_apart") & (rows == 1)).alias(ONCE))
