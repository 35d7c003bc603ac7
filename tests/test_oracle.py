"""Every registered query against its DuckDB oracle on the smallest dataset."""

import pytest

from tests.conftest import SMALL
from tests.oracle_check import compare, duck

from __spark_entry__ import oracle_sql, queries

from vintage.plans.catalog import QUERIES as OWN

KEYS = sorted(k for k in OWN if k in oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    from vintage.plans.catalog import QUERIES
    missing = set(QUERIES) - set(oracle_sql())
    assert not missing


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[key])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["country", "field_value", "cnt_base", "cnt_new"]
    assert df.count() > 0


def test_publish_postings_job(spark):
    from vintage.plans.publish import publish_postings
    m = publish_postings(spark, SMALL).collect()
    assert len(m) == 12 and all(r.status == "ok" and r.rows > 0 for r in m), m
    comp = [r for r in m if r.artifact == "comp"][0]
    fields = {r.field for r in spark.read.parquet(comp.path).select("field").distinct().collect()}
    assert fields == {"industry", "employer", "degree", "onet_name", "soc2", "city", "state", "msa", "title"}


def test_export_bundle(spark):
    from vintage.plans.publish import publish_export_bundle
    m = publish_export_bundle(spark, SMALL).collect()
    assert len(m) == 8 and all(r.status == "ok" and r.rows > 0 and r.description for r in m), m


def test_published_tables_are_read_by_name_and_replaced(spark, tmp_path):
    from vintage.plans.publish import publish
    from vintage.sources.tables import read_result
    a = spark.createDataFrame([("x", 1), ("y", 2)], "field string, n int")
    for df, want in ((a, {("x", 1), ("y", 2)}), (a.filter("field = 'x'"), {("x", 1)})):
        m = publish(spark, {"comp": (lambda df=df: df, ["field"])}, str(tmp_path / "out"), database="vintage_results")
        assert m.first().status == "ok", m.first()
        got = read_result(spark, "vintage_results.comp").select("field", "n")
        assert {tuple(r) for r in got.collect()} == want


def test_publish_manifest(spark):
    m = queries()["publish_manifest"](spark, SMALL).collect()
    assert {r.artifact for r in m} == {"comp", "kpi", "roles_benchmark", "employers_industry_benchmark"}
    assert all(r.status == "ok" and r.rows > 0 for r in m), m
