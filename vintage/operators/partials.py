"""Partial counts of many columns, without turning columns into rows.

A matrix counts every field of a row. Expanding each row to one row per
field multiplies the rows before the first reduction; here a task counts
each column of a batch by itself (Arrow's grouped counts over the batch's
dictionary) and passes on one row per distinct (keys, value) of the batch.
Spark merges those in its partial aggregation, so one exchange carries the
partial counts of all fields. A task holds one batch of ``BATCH`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vintage.sources.positions import ONCE, POS

#: Rows counted at a time.
BATCH = 1 << 16


def column_counts(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(_field, *keys, _value, _n)``, partial: rows by keys and value of
    ``columns[_field]``; NULL is no value. An array column counts its
    elements, trimmed of blanks."""
    return _partials(rows, list(keys), list(columns), None)


def column_words(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], scopes: Sequence[str | None]) -> DataFrame:
    """``(_field, *keys, _value, _word, _n, _bits)``, partial: the words of
    ``operators/distinct.py`` by keys and value of ``columns[_field]``, NULL
    included, over the rows whose flag ``scopes[_field]`` (None: all) is true.
    ``rows`` carry ``_pos`` and ``_once``."""
    return _partials(rows, list(keys), list(columns), list(scopes))


def _partials(rows: DataFrame, keys: list[str], columns: list[str], scopes: list[str | None] | None) -> DataFrame:
    ids = scopes is not None
    out = [T.StructField("_field", T.IntegerType())] + [T.StructField(k, rows.schema[k].dataType) for k in keys]
    out += [T.StructField("_value", T.StringType())]
    out += [T.StructField("_word", T.LongType())] if ids else []
    out += [T.StructField("_n", T.LongType())] + ([T.StructField("_bits", T.LongType())] if ids else [])
    schema = T.StructType(out)
    pos, once, size = POS, ONCE, BATCH

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def grouped(table, names, sums):
            return table.group_by(names, use_threads=False).aggregate(sums)

        def shaped(table, field, **given):
            n = table.num_rows
            every = {"_field": pa.array(np.full(n, field, np.int32)), "_value": table.column("v"), **{k: table.column(k) for k in keys}, **given}
            names = [f.name for f in schema]
            return pa.table([every[c] for c in names], names=names)

        def flat(table):
            """One row per list element."""
            lists = table.column("v").combine_chunks()
            rest = table.drop_columns("v").take(pc.list_parent_indices(lists))
            return rest.append_column("v", pc.utf8_trim(pc.list_flatten(lists), characters=" "))

        def counted(table):
            parts = []
            for i, name in enumerate(columns):
                use = table.select([*keys, name, *([pos, once] if ids else [])]).rename_columns([*keys, "v", *([pos, once] if ids else [])])
                if ids and scopes[i] is not None:
                    use = use.filter(table.column(scopes[i]))
                if pa.types.is_list(use.schema.field("v").type):
                    use = flat(use)
                if not ids:
                    use = use.filter(pc.is_valid(use.column("v")))
                    if use.num_rows:
                        got = grouped(use, [*keys, "v"], [([], "count_all")])
                        parts.append(shaped(got, i, _n=got.column("count_all")))
                    continue
                # rows that are counted, or have no id and count for nothing
                alone = pc.or_(use.column(once), pc.is_null(use.column(pos)))
                one = use.filter(alone)
                if one.num_rows:
                    one = one.append_column("w", one.column(once).cast(pa.int64()))
                    got = grouped(one, [*keys, "v"], [("w", "sum")])
                    empty = pa.nulls(got.num_rows, pa.int64())
                    parts.append(shaped(got, i, _word=empty, _n=got.column("w_sum"), _bits=empty))
                many = use.filter(pc.invert(alone))
                if many.num_rows:
                    # each bit once, so that their sum is their OR
                    got = grouped(many, [*keys, "v", pos], [])
                    at = got.column(pos).to_numpy().astype(np.int64)
                    got = got.drop_columns(pos).append_column("word", pa.array(at >> 6)).append_column(
                        "bit", pa.array(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64))))
                    got = grouped(got, [*keys, "v", "word"], [("bit", "sum")])
                    bits = pa.array(got.column("bit_sum").to_numpy().view(np.int64))
                    parts.append(shaped(got, i, _word=got.column("word"), _n=pa.array(np.zeros(got.num_rows, np.int64)), _bits=bits))
            for p in parts:
                yield from p.combine_chunks().to_batches()

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                yield from counted(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from counted(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)
