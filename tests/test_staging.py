"""Staged tables follow the dataset's files and the recipe's text."""

from vintage.sources.staging import staged


def test_rewritten_dataset_and_changed_recipe_give_new_tables(spark, tmp_path):
    root = str(tmp_path / "data")

    def write(n):
        spark.range(n).write.mode("overwrite").parquet(f"{root}/t.parquet")

    def rows(recipe="a", more=0):
        build = lambda: spark.read.parquet(f"{root}/t.parquet").union(spark.range(more))
        return staged(spark, root, "t", build, recipe=recipe).count()

    write(3)
    assert rows() == rows() == 3
    write(5)
    assert rows() == 5
    assert rows(recipe="b", more=2) == 7
    assert rows() == 5
