"""Session settings and the one place where intermediate results are cut from their lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Semantics every plan relies on: zone-free timestamps, errors on overflow and bad casts.
REQUIRED_CONF = {
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# A column file holds a row in a few bytes, a hashed row takes a hundred and a part becomes five stock rows, which no estimate
# counts: by the size of its files a table of millions of rows passes for small and is broadcast through the driver. And a
# task that reads 64 MB of compressed rows, the default, sorts and hashes a GB.
SIZE_CONF = {
    "spark.sql.sources.fileCompressionFactor": "250",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Runtime re-planning: partition coalescing, hot-partition splitting in joins, broadcast only
# where the measured size is below the threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "stockyard", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **SIZE_CONF, **RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_conf(spark: SparkSession) -> None:
    """Apply the semantic settings, and those that bound broadcasts and tasks, to a session somebody else built."""
    for key, value in {**REQUIRED_CONF, **SIZE_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the session; one is made up only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stockyard-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and read it from there.

    Needed where row placement (partition numbers) must not change when a lost task is run
    again, and between the rounds of an iteration.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
