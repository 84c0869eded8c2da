"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_written: list[str] = []           # folders of cut_lineage


def build_session(master: str | None = None, app: str = "leadlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session tuned for the funnel plans.

    AQE stays on so partition counts, skewed joins and broadcast choice are
    re-planned from real shuffle sizes. Small sides are broadcast only when
    Spark has measured them under ``autoBroadcastJoinThreshold``; above that
    the planner keeps a sort-merge join.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one. Only on a local master that names none, as in
    tests, a folder is made, and the context remembers it.
    """
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not d:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="leadlens-ckpt-"))
        d = context.getCheckpointDir()
    return d.rstrip("/")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's size (its optimizer's statistics); no job
    runs. It decides about the layout of a plan, never about its result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> int:
    """Delete what ``cut_lineage`` has written in this process; results that
    read it must have been used before. The number of tables deleted."""
    n = len(_written)
    while _written:
        delete_folder(spark, _written.pop())
    return n


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from it (never a machine-local folder, never
    ``localCheckpoint``).

    Unlike ``Dataset.checkpoint`` on an unpersisted plan, this computes the
    input once, and the re-read scan gives AQE real sizes. The table
    survives executor loss because it lives in the cluster's shared folder.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/leadlens-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)
