"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; this
module only offers a builder with the settings the operators are written
for (AQE on, UTC session clock, UI off) and a place to find the shared
checkpoint folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rewrite only the partitions a write touches (silver upsert, S7)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # MIN/MAX/COUNT answered from Parquet footers where possible (high-water mark)
    "spark.sql.parquet.aggregatePushdown": "true",
    # lineage cuts are reliable checkpoints; drop their files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A folder that the caller or the cluster (``spark.checkpoint.dir``) has
    set is used as it is and never replaced. Where none is set, a
    single-machine session (master ``local[...]``, as in tests) gets a folder
    of its own; on a cluster that would be one folder per machine, so it is
    an error there.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver "
                               "and all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, not local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
