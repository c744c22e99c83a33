"""Session helpers: a local session for tests/bench and the shared scratch
folder (``spark.checkpoint.dir``) used to cut lineage or stage files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this engine relies on. Event times carry no zone
# (the source data is UTC by contract), so the session zone must be UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "aerofeat", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no server started)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         # no Python call-site capture per Column call (error-message context
         # only); it costs several JVM round trips per function call
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Check the one setting results depend on: event times carry no zone, so
    the session's must be UTC. It is set where it is not, and a session that
    keeps another fails here. All other settings stay the caller's."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            raise RuntimeError("spark.sql.session.timeZone must be UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a machine-local folder is not
    visible to other executors and is lost with them). Only a local-mode
    session without the setting (tests, bench) gets a fresh temporary one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if d:
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
    d = tempfile.mkdtemp(prefix="aerofeat-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/aerofeat-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for staged tables."""
    return f"{_scratch(spark)}/{uuid.uuid4().hex}/{name}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove every staged table of this application, once the results read
    from them are written (a job's caller knows; the command line does it)."""
    drop_paths(spark, [_scratch(spark)])


def stage(df, name: str = "stage", fmt: str = "parquet"):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    For a result that several branches of a plan read (Spark would recompute
    it per branch): the written table cuts the lineage, survives the loss of
    an executor, and its columnar re-read is pruned to the columns each
    branch uses."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that this engine has written (a replaced partition, a
    staged table whose reader is done), through the file system Spark uses."""
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)
