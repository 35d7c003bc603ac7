"""Specifications: sources (releases / vendors), periods and fields.

A ``Source`` is one release or vendor table with its id and date columns and
its scope (country filter, crosswalk restriction). A ``FieldSpec`` says how
each source spells one field: a value expression per source, an optional
per-source preparation step (a lookup join, the "FROM override"), LIKE
exclusions on the normalised value, and extra predicates that apply to the
source's totals as well. Pipelines are functions of (sources, field, period).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import ts_lit

ColumnFn = Callable[[DataFrame], Column]
FrameFn = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Period:
    """Half-open date window ``[start, end)`` on a source's date column.

    Written as a range rather than ``YEAR(d) = y`` so the bounds reach the
    parquet scan as pushed filters.
    """

    start: str | None = None
    end: str | None = None

    @classmethod
    def year(cls, y: int) -> "Period":
        return cls(f"{y:04d}-01-01", f"{y + 1:04d}-01-01")

    @classmethod
    def since(cls, y: int) -> "Period":
        return cls(f"{y:04d}-01-01", None)

    @classmethod
    def always(cls) -> "Period":
        return cls(None, None)

    def predicate(self, date_col: str) -> Column:
        c = F.col(date_col)
        out = F.lit(True)
        if self.start is not None:
            out = out & (c >= ts_lit(self.start))
        if self.end is not None:
            out = out & (c < ts_lit(self.end))
        return out

    def apply(self, df: DataFrame, date_col: str) -> DataFrame:
        if self.start is None and self.end is None:
            return df
        return df.filter(self.predicate(date_col))


@dataclass(frozen=True)
class Source:
    """One release / vendor table.

    ``country``: optional (column, value) scope. ``restrict``: optional
    frame transform that narrows the rows. ``timeless``: the source ignores
    the period (the overlap sources are not year-filtered).

    Several sources may be views of one stored table (``table`` names it):
    they are then scanned once. A view narrowed by membership in another
    relation (the crosswalk) declares it as ``mark`` - a frame transform
    adding a flag column through a left join on de-duplicated keys, applied
    once per scan - plus ``member``, the predicate on that flag.
    """

    name: str
    frame: Callable[[], DataFrame]
    id: str
    date: str
    country: tuple[str, str] | None = None
    restrict: FrameFn | None = None
    timeless: bool = False
    table: str | None = None
    mark: FrameFn | None = None
    member: Callable[[], Column] | None = None

    @property
    def scan_key(self) -> str:
        return self.table or f"__{self.name}"

    def scope(self, period: Period | None = None, extra: Column | None = None) -> Column:
        """This view's row predicate over the (marked) table."""
        out = F.lit(True)
        if self.country is not None:
            out = out & (F.col(self.country[0]) == F.lit(self.country[1]))
        if period is not None and not self.timeless:
            out = out & period.predicate(self.date)
        if extra is not None:
            out = out & F.coalesce(extra, F.lit(False))
        if self.member is not None:
            out = out & F.coalesce(self.member(), F.lit(False))
        return out

    def scoped(self, period: Period | None = None, extra: Column | None = None) -> DataFrame:
        df = self.frame()
        if self.country is not None:
            df = df.filter(F.col(self.country[0]) == F.lit(self.country[1]))
        if period is not None and not self.timeless:
            df = period.apply(df, self.date)
        if extra is not None:
            df = df.filter(extra)
        if self.restrict is not None:
            df = self.restrict(df)
        if self.mark is not None:
            df = self.mark(df)
            if self.member is not None:
                df = df.filter(F.coalesce(self.member(), F.lit(False)))
        return df


@dataclass(frozen=True)
class FieldSpec:
    """How each source spells one field (see module doc)."""

    name: str
    exprs: Mapping[str, ColumnFn | str]
    prep: Mapping[str, FrameFn] = dc_field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    extra: Mapping[str, Callable[[], Column]] = dc_field(default_factory=dict)
    normalize: bool = True
    blank_is_null: bool = False

    def value(self, source: str, df: DataFrame) -> Column:
        e = self.exprs[source]
        c = F.col(e) if isinstance(e, str) else e(df)
        if self.normalize:
            c = F.upper(F.trim(c))
        if self.blank_is_null:
            c = F.nullif(c, F.lit(""))
        return c

    def extra_pred(self, source: str) -> Column | None:
        fn = self.extra.get(source)
        return None if fn is None else fn()

    def prepared(self, source: str, df: DataFrame) -> DataFrame:
        fn = self.prep.get(source)
        return df if fn is None else fn(df)
