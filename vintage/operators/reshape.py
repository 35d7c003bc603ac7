"""Reshape operators (R1-R3, D20) and the label-to-column pivot.

``wide`` turns a long ``(keys, label, measures)`` frame into one column per
(label, measure) by conditional aggregation over a *known* label list, so the
plan has a single exchange on the keys and no extra job to discover labels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide(df: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str],
         measures: Mapping[str, object], name: str = "{label}_{measure}") -> DataFrame:
    """Long -> wide. ``measures`` maps a measure column to its fill value for
    labels absent at a key (``None`` keeps NULL). Cells are summed, which is
    exact because each (key, label) holds one row after aggregation."""
    aggs = []
    for lab in labels:
        for m, fill in measures.items():
            cell = F.sum(F.when(F.col(label) == F.lit(lab), F.col(m)))
            if fill is not None:
                cell = F.coalesce(cell, F.lit(fill))
            aggs.append(cell.alias(name.format(label=lab, measure=m)))
    return df.groupBy(*keys).agg(*aggs)


def pivot_unique(df: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str],
                 value: str, check: bool = False) -> DataFrame:
    """R2: long -> wide with one value per cell. With ``check`` the same
    aggregation counts each cell's rows, and a cell of two or more raises
    when the result is computed, as pandas' pivot does (S14)."""
    aggs = []
    for lab in labels:
        here = F.col(label) == F.lit(lab)
        cell = F.first(F.when(here, F.col(value)), ignorenulls=True)
        if check:
            clash = F.raise_error(F.lit(f"pivot cells not unique for keys {list(keys)} x {label}: {lab}"))
            cell = F.when(F.count_if(here) > 1, clash.cast(df.schema[value].dataType)).otherwise(cell)
        aggs.append(cell.alias(lab))
    return df.groupBy(*keys).agg(*aggs)


def duplicate_cells(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """(keys, label) combinations held by more than one row (S14 check)."""
    return df.groupBy(*keys, label).count().filter(F.col("count") > 1)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str,
            value: str) -> DataFrame:
    """Wide -> long (``melt``)."""
    return df.unpivot(list(ids), list(values), variable, value)


def relabel(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Rename the values of a variable column; unknown values kept."""
    x = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v))
    return x if out is None else out.otherwise(x)


def fill_numeric(df: DataFrame, value: int | float = 0) -> DataFrame:
    """Fill NULLs with 0 in numeric columns only (text untouched; S29)."""
    return df.fillna(value)
