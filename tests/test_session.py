"""Session helpers: cluster sizing, the shared checkpoint folder, shipping code."""

from tillcast import session


def test_scale_conf_sizes_partitions_from_input():
    conf = session.scale_conf(100 * 2**40, 8000)  # 100 TB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    small = session.scale_conf(1 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # at least two waves of cores
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_materialize_writes_under_the_checkpoint_folder(spark):
    root = session.checkpoint_dir(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        assert ("/" + root.split(":", 1)[-1].lstrip("/")).startswith(conf.rstrip("/"))
    df = session.materialize(spark.range(5), "t")
    assert sorted(r.id for r in df.collect()) == list(range(5))
    strip = lambda u: "/" + u.split(":", 1)[-1].lstrip("/")  # noqa: E731  file:/x, file:///x -> /x
    assert all(strip(f).startswith(strip(root).rstrip("/") + "/tables/") for f in df.inputFiles())


def test_package_is_shipped_once(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    # a Python task can import the package
    names = spark.sparkContext.parallelize([0], 1).map(lambda _: __import__("tillcast").__name__).collect()
    assert names == ["tillcast"]


def test_drop_materialized_removes_written_tables(spark):
    import os

    df = session.materialize(spark.range(3), "gone")
    local = ["/" + f.split(":", 1)[-1].lstrip("/") for f in df.inputFiles()]
    assert all(os.path.exists(f) for f in local)
    assert session.drop_materialized(spark, "gone") == 1
    assert not any(os.path.exists(f) for f in local)
