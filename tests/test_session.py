import os

from pyspark import SparkConf

from quarry import session


def test_submitted_configuration_wins(monkeypatch):
    """build_session hands to the builder only what the submitter left unset."""
    seen = {}

    class Builder:
        def appName(self, _):
            return self

        master = appName

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            raise KeyboardInterrupt

    submitted = SparkConf(loadDefaults=False).set("spark.sql.session.timeZone", "CET").set("spark.driver.memory", "3g")
    monkeypatch.setattr(session, "SparkConf", lambda: submitted)
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    try:
        session.build_session("local[2]", spark__app__x="1")
    except KeyboardInterrupt:
        pass
    assert "spark.sql.session.timeZone" not in seen and "spark.driver.memory" not in seen
    assert "spark.sql.shuffle.partitions" not in seen and seen["spark.app.x"] == "1"


def test_only_single_jvm_masters_are_local():
    assert session.is_local("local") and session.is_local("local[4]")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")


def test_scratch_tables_are_deleted(spark):
    session.release_scratch(spark)
    root = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(f"{root}/quarry-tables"))
    kept, gone = session.materialize(spark.range(5), "t"), session.materialize(spark.range(5), "t")
    bucketed = session.materialize_bucketed(spark.range(5), "b", "id", 2)
    session.release(gone)
    assert kept.count() == bucketed.count() == 5
    assert len(set(os.listdir(f"{root}/quarry-tables")) - before) == 2
    assert session.release_scratch(spark) == 2
    assert set(os.listdir(f"{root}/quarry-tables")) == before


def test_components_of_a_long_path_and_a_star(spark):
    from quarry.operators.graph import connected_components

    path = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    edges = spark.createDataFrame(path + star, "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in [*range(301), *range(1000, 1400), 5000]], "node long")
    got = {r.node: r.component for r in connected_components(edges, nodes).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[i] == 1000 for i in range(1000, 1400)) and got[5000] == 5000
