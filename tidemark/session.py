"""Session settings and the scratch folder every job shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on; all can be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sessions are merged inside each map task first, so a busy key is shrunk before its shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    context = spark.sparkContext
    if context.master.startswith("local") and spark.conf.get(_PARTITIONS) == "200":
        # Spark's default suits a cluster; a local session gets one shuffle task per thread.
        spark.conf.set(_PARTITIONS, str(context.defaultParallelism))
    return spark


_PARTITIONS = "spark.sql.shuffle.partitions"

def build(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as `spark.checkpoint.dir` names it.

    Only a local session may go without: it gets a temporary folder, which all its tasks see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate, the number behind its automatic broadcast choice."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
