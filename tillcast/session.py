"""Session construction, the shared checkpoint folder, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every tillcast job relies on. AQE re-plans joins from measured sizes
# (broadcast when a shuffled side turns out small, skew splitting otherwise);
# ANSI stays on, so parses and divisions use the try_* forms.
_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_session(
    master: str | None = None,
    app_name: str = "tillcast",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above and the UI off.

    ``master`` is only for local runs and tests; on a cluster leave it unset
    and let spark-submit decide.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for k, v in _SQL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _SQL_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that keep shuffle and scan partitions near ``partition_bytes``.

    Start with enough shuffle partitions for the input (AQE coalesces the
    small ones at run time), split files at the same size, and let AQE split
    a partition that grows past four times that (a hot key).
    """
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset and the master is
    local (tests, laptops) is a scratch folder created, so that jobs that cut
    lineage still run there. On a cluster without the setting this raises:
    a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    scratch = tempfile.mkdtemp(prefix="tillcast-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tillcast`` importable in the executors' Python workers.

    Python code that runs inside tasks (the forecaster's group function)
    refers to this package by name, so the executors need it. Zipped once
    per application and added with ``addPyFile``; Spark copies the file to
    every executor, including ones that join later.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tillcast-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage in one pass (``DataFrame.checkpoint`` computes its input
    twice unless it is cached first), survives executor loss because the
    files live in the shared folder, and gives AQE real file sizes to plan
    the next stage with.
    """
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    remember_written(spark, path)
    back = spark.read.parquet(path)
    back.written_at = path
    return back


_WRITTEN: dict[str, list[str]] = {}


def remember_written(spark: SparkSession, path: str) -> None:
    """Have ``drop_materialized`` delete a folder that this application wrote."""
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)


def drop_materialized(spark: SparkSession, name: str | None = None) -> int:
    """Delete the tables this application wrote with ``materialize`` (only
    those called ``name`` when given).

    Call it once the results that read them have been consumed; returns the
    number of folders removed. Spark's own checkpoint cleaner does not know
    about these tables.
    """
    sc = spark.sparkContext
    written = _WRITTEN.get(sc.applicationId, [])
    match = lambda p: name is None or p.rsplit("/", 1)[-1].rsplit("-", 1)[0] == name
    paths = [p for p in written if match(p)]
    for p in paths:
        drop_written(spark, p)
    return len(paths)


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete one folder that this application wrote."""
    sc = spark.sparkContext
    written = _WRITTEN.get(sc.applicationId, [])
    if path in written:
        written.remove(path)
        hp = sc._jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hp, True)
