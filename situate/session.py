"""Session helpers: a sensible local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffles by the advisory size, not down to default parallelism only
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; a whole-stage method that big runs
    # interpreted (the event-cleaning stage was 1.8x slower), so let Spark split such stages
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "situate", cpus: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # under spark-submit the master is given
        builder = builder.master(f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SITUATE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session leaves it unset (local tests) do we pick our own
    folder and register it, so ``DataFrame.checkpoint()`` works too.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is not set: executors need a shared folder")
    if not root:
        root = tempfile.mkdtemp(prefix="situate-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # pragma: no cover - core conf not settable at run time
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder (never localCheckpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one job's output."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/situate/{name}-{uuid.uuid4().hex[:12]}"
