"""Published folders: a failed or cut-off write leaves the old output, and schemas are checked at reading."""

import pytest
from pyspark.sql import functions as F

from seriesmill.operators import learn
from seriesmill.sources import publish as P


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") / 7).alias("x"), F.lit("2020-01-02").cast("date").alias("d"))


def broken(spark):
    bad = F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id") / 7)
    return spark.range(100).select("id", bad.cast("double").alias("x"), F.lit("2020-01-02").cast("date").alias("d"))


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_failed_write_leaves_the_old_output(spark, tmp_path, kind):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        P.publish_table(broken(spark), path, kind)
    assert list(tmp_path.iterdir()) == []
    P.publish_table(numbers(spark, 5), path, kind)
    with pytest.raises(Exception, match="lost"):
        P.publish_table(broken(spark), path, kind)
    kept = P.read_published(spark, path, numbers(spark, 0).schema)
    assert kept.dtypes == numbers(spark, 0).dtypes
    assert sorted(kept.collect()) == sorted(numbers(spark, 5).collect())
    P.publish_table(numbers(spark, 3), path, kind)
    assert P.read_published(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_cut_off_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "out")
    P.publish_table(numbers(spark, 4), path)
    # As after a crash between the renames: the old folder aside, the new one complete beside it or not.
    (tmp_path / "out").rename(tmp_path / "out.old-abc-0")
    (tmp_path / "out.old-unmarked").mkdir()
    assert P.read_published(spark, path).count() == 4
    (tmp_path / "out").rename(tmp_path / "out.old-def-0")
    P.publish_table(numbers(spark, 6), path)
    assert P.read_published(spark, path).count() == 6


def test_unfinished_folders_and_other_schemas_are_errors(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(P.NotPublished):
        P.read_published(spark, path)
    numbers(spark, 2).write.parquet(path)
    with pytest.raises(P.NotPublished):
        P.read_published(spark, path)
    P.publish_table(numbers(spark, 2), path)
    for other in (numbers(spark, 0).drop("x"), numbers(spark, 0).withColumn("x", F.col("x").cast("float")), numbers(spark, 0).select("x", "id", "d")):
        with pytest.raises(P.NotPublished):
            P.read_published(spark, path, other.schema)
    with pytest.raises(ValueError):
        P.publish_table(numbers(spark, 1), path, "orc2")
    assert P.read_published(spark, path).count() == 2


def test_empty_table_and_folders_by_column(spark, tmp_path):
    P.publish_table(numbers(spark, 0), str(tmp_path / "none"))
    assert P.read_published(spark, str(tmp_path / "none"), numbers(spark, 0).schema).count() == 0
    parted = numbers(spark, 6).withColumn("side", (F.col("id") % 2).cast("int"))
    P.publish_table(parted, str(tmp_path / "parts"), partition_by=["side"])
    found = P.read_published(spark, str(tmp_path / "parts"))
    assert sorted(found.select(*parted.columns).collect()) == sorted(parted.collect())


def test_parameter_table_scores_as_the_pipeline(spark, tmp_path):
    rows = spark.range(200).select(
        (F.col("id") % 13).cast("double").alias("a"),
        F.lit(3.0).alias("still"),
        F.element_at(F.array(*map(F.lit, ["u", "v", "w"])), (F.col("id") % 3 + 1).cast("int")).alias("kind"),
        (F.col("id") * 0.5 + F.col("id") % 3).alias("y"),
    )
    path = str(tmp_path / "m")
    learn.save(learn.fit(rows, learn.linear("y"), ["a", "still"], "kind"), path)
    parameters = learn.load_parameters(spark, path)
    assert parameters.count() == 1 + 3 + 2
    by_table = learn.score_by_parameters(rows, parameters)
    both = learn.score(learn.load(path), by_table, "piped")
    assert both.where("abs(predicted - piped) > 1e-9").count() == 0
    with pytest.raises(Exception, match="unknown level"):
        learn.score_by_parameters(rows.withColumn("kind", F.lit("x")), parameters).collect()
    empty = rows.withColumn("kind", F.lit(None).cast("string"))
    assert learn.score_by_parameters(empty, parameters).where("predicted IS NOT NULL").count() == 0
