import time

from seriesmill import session


def shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_shuffle_files_go_with_the_end_of_a_stage(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session.FREE_SHUFFLES, None)
    rows = session.stage(spark.range(20_000).selectExpr("id % 1000 AS k").groupBy("k").count(), "counted")
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert rows.count() == 1000
    assert spark.conf.get(session.FREE_SHUFFLES, None) == setting


def test_the_setting_is_put_back_when_a_write_fails(spark):
    setting = spark.conf.get(session.FREE_SHUFFLES, None)
    failing = spark.range(10).selectExpr("CASE WHEN id = 5 THEN raise_error('no') ELSE 'x' END AS x")
    try:
        session.stage(failing, "failing")
    except Exception as error:
        assert "no" in str(error)
    else:
        raise AssertionError("the write did not fail")
    assert spark.conf.get(session.FREE_SHUFFLES, None) == setting
