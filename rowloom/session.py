"""Session settings the library counts on."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    # sheet dates have no zone; serial dates are read as UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: broadcasts by measured size, skewed join partitions split, small
    # shuffle partitions put together
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# To be given when the session is made: Python call sites of every expression are only of use
# while debugging, and wide tables have thousands of expressions.  Sources that are loaded side by
# side share the executors fairly.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false", "spark.scheduler.mode": "FAIR"}


def configure(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session; safe to repeat."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Python workers look for the package where the driver has found it; a cluster that keeps it elsewhere has it installed
    context, own = spark.sparkContext, str(Path(__file__).resolve().parents[1])
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if own not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([own, *filter(None, paths)])
    return spark
