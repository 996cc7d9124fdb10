"""Spark session settings the engine relies on.

The reports rely on ANSI casts and adaptive execution with partition
coalescing and skew-join splitting — all Spark 4 defaults. On a cluster the
session exists already: :func:`configure` never overrides a value the
session or the cluster has, it only fills keys that have no value at all,
and :func:`checkpoint_dir` reads ``spark.checkpoint.dir`` when something is to
be written there. Results do not depend on
the session time zone: source timestamps are TIMESTAMP_NTZ and "today" is an
explicit ``as_of`` date.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Settings every job wants; applied only when the session has no value at all.
ENGINE_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


GIB = 1 << 30
MIB = 1 << 20


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` on ``total_cores`` task slots.

    * Shuffle partitions: about one per 2 GiB of input, at least two waves
      of the cores (the largest shuffles here run after filters and map-side
      aggregation, so they are far smaller than the input). Adaptive
      execution then coalesces small partitions towards 256 MiB and splits
      skewed ones.
    * Scan splits of 256 MiB: fewer, fuller tasks for very large tables.
    * Broadcasts stay measured: adaptive execution broadcasts a join side
      only when its real shuffle output is below 64 MiB.
    """
    parts = max(2 * total_cores, -(-input_bytes // (2 * GIB)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
    }


def configure(spark: SparkSession, input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Apply :data:`ENGINE_DEFAULTS` where unset; make sure a checkpoint dir exists.

    With ``input_bytes`` and ``total_cores`` the :func:`cluster_settings`
    are applied too — again only where the session has no explicit value.
    """
    wanted = dict(ENGINE_DEFAULTS)
    if input_bytes is not None and total_cores:
        wanted.update(cluster_settings(input_bytes, total_cores))
    explicit = _explicit_keys(spark)
    for key, value in wanted.items():
        if key in ENGINE_DEFAULTS and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
        elif key not in ENGINE_DEFAULTS and key not in explicit:
            spark.conf.set(key, value)
    sc = _context(spark)
    if sc is not None:  # Python workers on this machine find the package (a cluster gets it by --py-files)
        sc.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediates and stream checkpoints: ``spark.checkpoint.dir``.

    A cluster must name one that the driver and all executors share; without it
    this raises. Only a local master, where all tasks run on this machine, gets a
    folder of its own under the JVM's temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path and re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            path = f"file:{sc._jvm.System.getProperty('java.io.tmpdir')}/ledgerline-{sc.applicationId}"
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return path


def _explicit_keys(spark: SparkSession) -> set[str]:
    """Keys the user or cluster set explicitly (launch config)."""
    sc = _context(spark)
    if sc is None:
        return set()
    return {k for k, _ in sc.getConf().getAll()}


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in ENGINE_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
