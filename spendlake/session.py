"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# splits skewed partitions and coalesces small ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "spendlake") -> SparkSession:
    """A local session for tests and the bench (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPENDLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings (dots as ``__``) for what runs inside; then the old ones again."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    old = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session's ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    scratch folder when none is set; on a cluster a missing setting is an
    error, since other machines could not read a local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not configured:
        held = context._jsc.sc().getCheckpointDir()
        configured = held.get() if held.isDefined() else None
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spendlake-ckpt-")
        context.setCheckpointDir(configured)
    return configured
