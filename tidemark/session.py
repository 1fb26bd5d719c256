"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    # Recording the Python call site of every column slows down the building of large plans.
    builder = SparkSession.builder.appName(app).config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


# Used unless the cluster sets its own value.
TUNING = {
    # The JVM does not compile methods over 8000 bytes. Decoding a wide entity generates more than
    # that as one stage, and runs faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # At run time, once shuffled sizes are known, a join whose smaller side fits per partition
    # hashes that side and saves sorting the larger one.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Plans show a scan's filters whole; they were cut at 100 characters, after fewer of them the higher the columns' numbers.
    "spark.sql.maxMetadataStringLength": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """The few settings the package depends on; everything else is left to the cluster."""
    # A JSON object with a repeated field keeps its last value.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    for name, value in TUNING.items():
        # Whatever the cluster or the user has set, also at run time, stays.
        if spark.conf.get(name, None) is None and not spark.sparkContext.getConf().contains(name):
            spark.conf.set(name, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder; below the warehouse only for a local master without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        root = f"{warehouse}/_scratch/{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, never used before."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
