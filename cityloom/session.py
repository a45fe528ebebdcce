"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_LOCAL_ROOTS: dict[str, str] = {}
_MARKED: set[str] = set()


def get_session(app_name: str = "cityloom", **conf: str) -> SparkSession:
    """Return a session with UTC timestamps and adaptive execution."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder. On a
    cluster a machine-local folder would not be visible to the other executors, so it is refused.
    """
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    """One folder per application, which Hadoop's file system removes when the application ends: readers of
    its tables may be evaluated at any time before."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="cityloom-")
        root = _LOCAL_ROOTS[app]
    folder = f"{root.rstrip('/')}/cityloom/{app}"
    if folder not in _MARKED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the scratch folder and read it back: it is computed once, its plan starts
    anew, and a lost executor costs no more than re-reading it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``materialise``, and the number of rows, which is counted as they are written."""
    seen = Observation()
    made = materialise(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return made, seen.get["n"]


def materialise_bucketed(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``materialise``, with rows dealt to files by ``keys`` and sorted by them: what joins or groups by these keys
    later needs no exchange. There are as many buckets as shuffle partitions."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"cityloom_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.option("path", scratch_path(spark, label)).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    made = spark.table(name)
    made.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return made
