"""NULL ids are no entities; one hot id; values that only NULL ids hold."""

from vintage.operators import coverage as cov
from vintage.operators import distribution as dist
from vintage.spec import FieldSpec, Source


def _source(spark):
    rows = [(1, "a"), (2, "a"), (None, "a"), (None, "only"), (2, None)] + [(7, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v string")
    return Source("s", lambda: df, id="id", date="d")


def test_null_ids(spark):
    s = _source(spark)
    f = FieldSpec("v", {"s": "v"}, normalize=False)
    counts, totals = dist.counts_and_totals(dist.value_words(dist.tagged([s], f, None)))
    got = {r.field_value: r.n for r in counts.collect()}
    assert got["a"] == 2 and got["only"] == 0 and got["v5"] == 1 and len(got) == 202
    assert totals.first().total == 3
    c = cov.coverage([s], f, None).first()
    assert (c.total, c.covered) == (3, 3)
    for df in (counts, totals):
        assert "ObjectHashAggregate" not in df._jdf.queryExecution().executedPlan().toString()
