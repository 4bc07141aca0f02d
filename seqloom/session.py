"""Session settings the library relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to change on a running session.
RUNTIME_CONF = {
    # all wall-clock arithmetic below is written against UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated key in a score map keeps its first place and its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # lets `row_number() <= k` prune before the shuffle for k up to the export size (1500)
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for the few operators that
    run Python there. Not needed where it is installed or passed with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="seqloom-ship-")) / package.name
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seqloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
