"""Session settings the plans are meant to run with."""
from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    # computed values that overflow raise instead of becoming NULL
    "spark.sql.ansi.enabled": "true",
    # runtime re-planning: small measured lookups are broadcast, hot join keys split, small partitions merged
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle further on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # checkpoint files go away with the frames that own them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder. Shuffle partitions and memory stay the cluster's business."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
