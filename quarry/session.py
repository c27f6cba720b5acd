"""Session construction and a few cluster-safety helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Defaults for a session that nobody has configured.  ``build_session`` fills in
# only keys that the submitter (spark-submit, SparkConf, builder) has left unset.
# The shuffle partition count is not among them: AQE coalesces Spark's default on
# small data, and on a cluster the submitter sizes it.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
LOCAL_DEFAULTS = {"spark.driver.memory": "16g"}


def build_session(master: str | None = None, app: str = "quarry", **conf: str) -> SparkSession:
    submitted = SparkConf()
    merged = dict(DEFAULTS)
    if is_local(master or submitted.get("spark.master", "")):
        merged.update(LOCAL_DEFAULTS)
    merged = {k: v for k, v in merged.items() if not submitted.contains(k)}
    merged.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """True for single-JVM masters (``local``, ``local[n]``), not for ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used.  Only a single-JVM session without the
    setting (tests, laptops) gets a fresh temporary folder, removed when the
    process ends; a cluster session without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured if spark.conf.get("spark.checkpoint.dir", None) else sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quarry-tables/{name}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that ``release_scratch`` deletes with the other scratch tables."""
    path = scratch_path(spark, name)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []
_TABLES: dict[str, str] = {}  # path → catalog name of the bucketed ones


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read
    it back.  Cuts lineage like ``checkpoint()`` but the copy is columnar, so
    later readers get column pruning and filter pushdown; it survives the loss
    of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    _SCRATCH.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``materialize`` as a table bucketed by ``key``: joins and aggregations on the key
    read it without a shuffle of this side.  The files lie under the checkpoint folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"quarry_{name}_{uuid.uuid4().hex}".replace("-", "_")
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    _SCRATCH.append(path)
    _TABLES[path] = table
    out = spark.table(table)
    out._scratch_path, out._buckets = path, buckets
    return out


def forget(spark: SparkSession, path: str) -> None:
    if path in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")
    delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release(df: DataFrame) -> None:
    """Delete the files of a ``materialize``d frame that nothing reads any more
    (an earlier round of a loop, an index that has been replaced)."""
    path = getattr(df, "_scratch_path", None)
    if path in _SCRATCH:
        _SCRATCH.remove(path)
        forget(df.sparkSession, path)


def release_scratch(spark: SparkSession) -> int:
    """Delete every scratch table written so far by this driver; call it once the
    results that read them have been stored.  Returns how many were deleted."""
    n = 0
    while _SCRATCH:
        forget(spark, _SCRATCH.pop())
        n += 1
    return n


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor
    (``--py-files`` for a session that was started without it)."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quarry-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "quarry.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._quarry_shipped = True


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Input-parallelism guard for CPU-heavy row operators (regex, shingling).

    A scan yields one split per file chunk / row group.  When that gives fewer
    splits than the cluster has cores, rows are dealt round-robin over
    ``factor × cores`` partitions; at scale (many more splits than cores) the
    frame is returned untouched and no shuffle is added.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= factor * cores:
        return df
    return df.repartition(factor * cores)
