"""Scratch folder rules: read spark.checkpoint.dir from the session, write under it."""

from wordlens.session import materialize, scratch_path, scratch_root


def test_scratch_root_follows_session_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert scratch_path(spark, "x", unique=False) == f"{root}/x"
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(f"{root}/x/")


def test_materialize_writes_a_table_under_the_root(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    out = materialize(df, "test-materialize")
    assert out.count() == 100
    files = out.inputFiles()
    assert files and all(scratch_root(spark) in f for f in files)
    assert "Scan parquet" in out._jdf.queryExecution().executedPlan().toString() or \
        "FileScan parquet" in out._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    import pytest

    from wordlens import session
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        pytest.skip("the session names a folder")
    monkeypatch.setattr(session, "_LOCAL_ROOTS", {})
    monkeypatch.setattr(type(spark.sparkContext), "master", "spark://host:7077", raising=False)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(spark)


def test_a_saved_table_is_replaced_as_a_whole(spark):
    from wordlens.sinks.tables import read_saved, save_table, view_name
    a = save_table(spark.range(3), "numbers", "one")
    old = spark.table(view_name("numbers", "one"))
    b = save_table(spark.range(5), "numbers", "one")
    save_table(spark.range(7), "numbers", "two")
    assert a != b and read_saved(spark, a).count() == 3 == old.count()
    assert spark.newSession().table("wordlens.one_numbers").count() == 5 and spark.table("wordlens.two_numbers").count() == 7


def test_held_readers_read_and_old_versions_go(spark):
    """A reader that was opened before four further versions still reads; versions replaced long enough ago go."""
    from wordlens.sinks.tables import expire, open_table, save_table
    save_table(spark.range(1), "held", "one")
    held = open_table(spark, "held", "one")
    for n in range(2, 6):
        save_table(spark.range(n), "held", "one", keep_seconds=3600)
    assert held.count() == 1 and open_table(spark, "held", "one").count() == 5
    assert expire(spark, "held", "one", 3600) == []
    assert len(expire(spark, "held", "one", 0)) == 4 and expire(spark, "held", "one", 0) == []
    assert open_table(spark, "held", "one").count() == 5
    save_table(spark.range(9), "held", "one", keep_seconds=0)
    assert open_table(spark, "held", "one").count() == 9


def test_a_table_without_a_catalogue_entry_is_attached(spark):
    """As another application finds it, whose catalogue does not know the table: from the shared folder."""
    import pytest

    from wordlens.sinks.tables import open_table, save_table, view_name
    save_table(spark.range(4), "found", "one")
    newest = save_table(spark.range(6), "found", "one")
    spark.sql(f"DROP VIEW {view_name('found', 'one')}")
    assert open_table(spark, "found", "one").count() == 6 and spark.table(newest).count() == 6
    with pytest.raises(LookupError, match="no table"):
        open_table(spark, "nothing", "one")


def test_a_scope_empties_its_scratch_tables(spark):
    import os

    from wordlens.session import scratch_scope
    outside = materialize(spark.range(1000), "test-scope")
    with scratch_scope(spark):
        inside = materialize(spark.range(100_000).selectExpr("id", "array(id) AS a"), "test-scope")
        assert inside.count() == 100_000
        files = [f.removeprefix("file://") for f in inside.inputFiles()]
    assert outside.count() == 1000
    assert not any(os.path.exists(f) for f in files)
    again = spark.read.parquet(os.path.dirname(files[0]))
    assert again.count() == 0 and again.columns == ["id", "a"]
