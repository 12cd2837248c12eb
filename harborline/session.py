"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "harborline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; extra settings override the defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    return b.config(map=settings).getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only in local mode, as in tests, may it be unset; a local one serves then."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="harborline-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder, which is deleted when the application ends."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/harborline/{app}"
    if _deleted_at_exit.get(app) != path:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _deleted_at_exit[app] = path
    return path


_deleted_at_exit: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, gives real sizes."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def comparable(df: DataFrame) -> DataFrame:
    """df with timestamps as microseconds since 1970 UTC, integers as long and fractions rounded to six digits."""
    kinds = {"timestamp": lambda c: F.unix_micros(c), "int": lambda c: F.col(c).cast("long"), "double": lambda c: F.round(c, 6)}
    return df.select(*[kinds[k](f"`{c}`").alias(c) if k in kinds else F.col(f"`{c}`") for c, k in df.dtypes])


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df, from file sizes; needs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where it is a plain scan of fewer partitions than these; for steps that cost far more than a shuffle of so few files.

    Larger inputs have more partitions and are left alone, as is anything that was shuffled already.
    """
    if df.isStreaming:
        return df
    cores, plan = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName() or "Exchange" in plan.toString() or plan.execute().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; zoneless timestamps are read as UTC instants."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    ntz = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: df[c].cast("timestamp") for c in ntz}) if ntz else df
