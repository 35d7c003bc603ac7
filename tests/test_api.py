"""Library helpers not exercised by a registered query."""

from vintage.functions import expr as X
from vintage.operators import reshape as rs
from vintage.operators.joins import lookup, norm_join
from vintage.sources.tables import read_release


def test_relabel_unique_pivot_and_duplicates(spark):
    df = spark.createDataFrame([("m1", "cnt_a", 1), ("m1", "cnt_b", 2), ("m2", "cnt_a", 3)],
                               "k string, version string, v long")
    lab = {r.version for r in df.select(rs.relabel("version", {"cnt_a": "A"}).alias("version")).collect()}
    assert lab == {"A", "cnt_b"}
    w = {r.k: (r.cnt_a, r.cnt_b) for r in rs.pivot_unique(df, ["k"], "version", ["cnt_a", "cnt_b"], "v").collect()}
    assert w == {"m1": (1, 2), "m2": (3, None)}
    assert rs.duplicate_cells(df, ["k"], "version").count() == 0
    assert rs.duplicate_cells(df.union(df), ["k"], "version").count() == 3


def test_fill_numeric_leaves_text(spark):
    df = spark.createDataFrame([(None, None)], "s string, n long")
    r = rs.fill_numeric(df).first()
    assert (r.s, r.n) == (None, 0)


def test_text_helpers(spark):
    df = spark.createDataFrame([("  o'neil-smith ",)], "s string")
    r = df.select(X.title_case(X.lower_trim("s")).alias("t"), X.norm("s").alias("u")).first()
    assert (r.t, r.u) == ("O'neil-smith", "O'NEIL-SMITH")


def test_norm_join_and_lookup(spark):
    a = spark.createDataFrame([(1, " sales "), (2, "x")], "id long, name string")
    b = spark.createDataFrame([("SALES", "S1")], "label string, code string")
    assert [(r.id, r.code) for r in norm_join(a, b, "name", "label").collect()] == [(1, "S1")]
    c = spark.createDataFrame([(1, "a")], "id long, extra string")
    assert lookup(a, c, "id").count() == 2


def test_versioned_release_path(spark, tmp_path):
    spark.createDataFrame([(1,)], "x long").write.parquet(str(tmp_path / "v5" / "experience"))
    assert read_release(spark, str(tmp_path), "v5", "experience").count() == 1


def test_cli_runs_the_profile_job(spark, tmp_path, capsys):
    from vintage.__main__ import main
    from tests.conftest import SMALL
    # build_session reuses the running session; main() must not stop it here
    import vintage.__main__ as cli
    orig = cli.build_session
    cli.build_session = lambda *a, **k: spark
    stop = spark.stop
    spark.stop = lambda: None
    try:
        assert main(["profiles", "--data", SMALL, "--out", str(tmp_path / "res")]) == 0
    finally:
        cli.build_session = orig
        spark.stop = stop
    out = capsys.readouterr().out
    assert "comp\tok" in out and "kpi\tok" in out
