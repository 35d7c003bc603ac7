"""One scan per stored table, whatever the number of sources reading it.

Sources that are views of the same table (``Source.table``) are read in one
scan: the table's marks and the enrichment joins the views need are applied
once, and each row is emitted once for every view whose scope it satisfies
(an ``inline`` of one struct per view). Either way the scope predicates
reach the parquet scan (for shared scans as an OR of the views' predicates,
whose common terms Catalyst factors out).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.sources.positions import ONCE, POS, positioned
from vintage.spec import FrameFn, Period, Source

Project = Callable[[Source, DataFrame], list[Column]]


def scan_union(sources: Sequence[Source], period: Period | None, project: Project,
               extra: Callable[[Source], Column | None] | None = None,
               prep: Callable[[Source], Sequence[FrameFn]] | None = None,
               since: Callable[[Source], Column | None] | None = None, ids: bool = False) -> DataFrame:
    """Rows ``(source, *project(source, df))`` of every source, in scope.

    ``project`` returns aliased columns (the same names for every source);
    ``extra`` gives a source's additional predicate; ``prep`` its enrichment
    (each distinct transform is applied once per table); ``since`` a
    predicate that, unlike the period, also applies to timeless sources. With
    ``ids`` rows carry the position of their id (``sources/positions.py``), made
    here for a table that is stored without. An enrichment may give a row
    several copies; unless it says that it marks those itself (``marks_copies``),
    no id counts as occurring once after it.
    """
    groups: dict[str, list[Source]] = {}
    for s in sources:
        groups.setdefault(s.scan_key, []).append(s)
    frames = []
    for members in groups.values():
        if len(members) > 1 and any(s.restrict is not None for s in members):
            raise ValueError("sources sharing a table narrow it with mark/member, not restrict")
        df = members[0].frame()
        if members[0].restrict is not None:
            df = members[0].restrict(df)
        if ids and POS not in df.columns:
            df = positioned(df, members[0].id)
        place = [F.col(POS), F.col(ONCE)] if ids else []
        applied: list[FrameFn] = []
        transforms = [s.mark for s in members]
        for s in members:
            transforms += list(prep(s)) if prep else []
        for fn in transforms:
            if fn is not None and fn not in applied:
                df = fn(df)
                applied.append(fn)
                if ids and fn not in [s.mark for s in members] and not getattr(fn, "marks_copies", False):
                    df = df.withColumn(ONCE, F.lit(False))
        scopes = []
        for s in members:
            sc = s.scope(period, extra(s) if extra else None)
            cut = since(s) if since else None
            scopes.append(sc if cut is None else sc & cut)
        if len(members) == 1:
            s = members[0]
            frames.append(df.filter(scopes[0]).select(F.lit(s.name).alias("source"), *project(s, df), *place))
            continue
        any_scope = scopes[0]
        for sc in scopes[1:]:
            any_scope = any_scope | sc
        items = [F.struct(F.lit(s.name).alias("source"), sc.alias("_in"), *project(s, df), *place)
                 for s, sc in zip(members, scopes)]
        frames.append(df.filter(any_scope).select(F.inline(F.array(*items)))
                      .filter("_in").drop("_in"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
