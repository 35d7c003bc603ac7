"""The releases of a table, found by version and brought to one schema (A1, A2).

Releases lie at ``{root}/{version}/{table}``. Between releases columns come,
go, are renamed and change type; a comparison names releases, not their
schemas. ``aligned`` gives every release the same columns: matched by name
(any case, and by stated renames), each in the narrowest type that holds all
releases' values, and with a stated default, else NULL, where a release has
none. Everything is a projection over the release's scan, so unused columns
are still pruned. ``drift`` reports what was done.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.sources.snapshots import _Files
from vintage.sources.tables import read_release

#: Numbers from narrow to wide; an integer with a fraction type goes to double.
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FRACTION = [T.FloatType(), T.DoubleType()]


def versions(spark: SparkSession, root: str, table: str) -> list[str]:
    """Versions under ``root`` that have ``table``, numbers in their order."""
    files = _Files(spark, root)
    have = [v for v in files.names(root) if files.fs.exists(files.path(f"{root.rstrip('/')}/{v}/{table}"))]
    return sorted(have, key=lambda v: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", v)])


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if a in _FRACTION and b in _FRACTION:
        return T.DoubleType()
    # a long beyond 2^53 is no double: such columns meet as text
    if {a, b} & set(_FRACTION) and {a, b} & set(_WHOLE[:3]):
        return T.DoubleType()
    whens = (T.DateType(), T.TimestampNTZType())
    if a in whens and b in whens:
        return T.TimestampNTZType()
    return T.StringType()


class Releases:
    """All releases of one table, read through one schema."""

    def __init__(self, spark: SparkSession, root: str, table: str, renames: Mapping[str, str] | None = None,
                 defaults: Mapping[str, object] | None = None):
        self.names = versions(spark, root, table)
        self.raw = {v: read_release(spark, root, v, table) for v in self.names}
        self.defaults = {k.lower(): v for k, v in (defaults or {}).items()}
        new_names = {k.lower(): v.lower() for k, v in (renames or {}).items()}
        #: release -> column -> (name there, type there)
        self.found: dict[str, dict[str, tuple[str, T.DataType]]] = {}
        for v, df in self.raw.items():
            own = self.found[v] = {}
            for f in df.schema:
                name = new_names.get(f.name.lower(), f.name.lower())
                if name in own:
                    raise ValueError(f"release {v} has two columns for {name}: {own[name][0]}, {f.name}")
                own[name] = (f.name, f.dataType)
        self.schema: dict[str, T.DataType] = {}
        for own in self.found.values():
            for name, (_, kind) in own.items():
                self.schema[name] = wider(self.schema.get(name, T.NullType()), kind)

    def aligned(self) -> dict[str, DataFrame]:
        """release -> its rows under the common schema."""
        out = {}
        for v, df in self.raw.items():
            own = self.found[v]
            out[v] = df.select(*[(F.col(own[c][0]) if c in own else F.lit(self.defaults.get(c))).cast(kind).alias(c)
                                 for c, kind in self.schema.items()])
        return out

    def drift(self) -> list[tuple[str, str, str, str | None, str]]:
        """(release, column, change, type there, common type) of every column
        that is not simply there: ``renamed``, ``widened``, ``absent``, and
        ``dropped`` where an earlier release still had it."""
        out, before = [], set()
        for v, own in self.found.items():
            for c, kind in self.schema.items():
                if c not in own:
                    out.append((v, c, "dropped" if c in before else "absent", None, kind.simpleString()))
                    continue
                name, there = own[c]
                if name.lower() != c:
                    out.append((v, c, f"renamed from {name}", there.simpleString(), kind.simpleString()))
                if there != kind:
                    out.append((v, c, "widened", there.simpleString(), kind.simpleString()))
            before |= set(own)
        return out
