import pytest

from scrivel.llm.landing import landed, shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Unset:
    """A session without the setting."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:  # noqa: N801
        applicationId, master = "app-of-this-test", "local[2]"


def test_tables_go_to_the_folder_that_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    table = landed(spark.range(10).groupBy("id").count(), "counts")
    assert table.count() == 10
    assert folder is None or all(f"{folder.removeprefix('file://')}/counts-" in f for f in table.inputFiles())


def test_only_a_single_machine_may_leave_it_unset(monkeypatch):
    own = shared_dir(_Unset)
    assert shared_dir(_Unset) == own
    monkeypatch.setattr(_Unset.sparkContext, "master", "spark://somewhere:7077")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(_Unset)


def test_an_empty_table_keeps_its_columns(spark):
    empty = landed(spark.createDataFrame([], "a long, b array<string>"))
    assert empty.columns == ["a", "b"]
    assert empty.collect() == []


def test_settings_are_as_before(spark):
    spark.conf.set(CLEANUP, "false")
    landed(spark.range(3))
    assert spark.conf.get(CLEANUP) == "false"
    with pytest.raises(Exception, match="zero|ZERO"):
        landed(spark.range(3).selectExpr("id", "raise_error('by zero')"))
    assert spark.conf.get(CLEANUP) == "false"
