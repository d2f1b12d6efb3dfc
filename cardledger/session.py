"""Session settings, scratch folder and run timestamp."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# One card account, customer or input file can own a third of a feed.  Every
# join of the engine keeps the feed on the left and a unique-key table on the
# right (left, left_semi, left_anti), the shapes in which adaptive execution
# may cut a hot left partition by map output, identical rows included.  The
# "force" switch keeps that cut even when a group-by on the same key follows.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where every shuffled partition of the keyed table is this small, it is hashed
    # and the feed beside it is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # Buckets are one sorted file each: a bucket is always one task, and is not sorted again.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive features the plans count on."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "cardledger", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def run_timestamp(spark: SparkSession) -> str:
    """UTC ``yyyyMMddHHmmss``; jobs take it as an argument, this is its default."""
    clock = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyyMMddHHmmss")
    return spark.range(1).select(clock.alias("now")).first()["now"]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the shared folder of the cluster.

    Where the setting is absent a folder of this machine serves a ``local[*]``
    master only; on a cluster each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/cardledger-{uuid.uuid4().hex}/{label}"
