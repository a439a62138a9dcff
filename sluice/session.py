"""Session construction and shared scratch space.

Every job reads its scratch root from ``spark.checkpoint.dir`` – the shared folder the
cluster names – so intermediate tables survive executor loss.  A local default is set only
when the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sluice", extra: dict | None = None) -> SparkSession:
    """Session with UTC, ANSI, AQE (incl. skew-join split) and the UI off."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if master.startswith("local["):  # executors elsewhere could not reach a driver on 127.0.0.1
        conf |= {"spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1"}
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``, or the context's
    checkpoint dir); name a local one only where neither is set and all runs in one process, as in
    tests.  On a cluster without one this raises: a machine-local folder would lose data."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        ctx = spark.sparkContext
    except Exception:  # noqa: BLE001 – no local context handle
        ctx = None
    if not current:
        ctx_dir = ctx.getCheckpointDir() if ctx is not None else None
        if ctx_dir:
            # the context appends a random sub-folder; scratch goes next to it
            current = ctx_dir.rstrip("/").rsplit("/", 1)[0]
        else:
            if ctx is not None and not ctx.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            current = os.environ.get("SLUICE_CHECKPOINT_DIR") or os.path.join(
                "/tmp", f"sluice-ckpt-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", current)
    if ctx is not None and ctx.getCheckpointDir() is None:
        ctx.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for one job's tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside; the session's own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Map outputs x shuffle partitions are blocks that the driver tracks; beyond this many partitions a shuffle of
#: hundreds of thousands of map tasks has more blocks than it can serve.
MAX_SHUFFLE_PARTITIONS = 100_000


def cluster_settings(shuffled_bytes: int, total_cores: int,
                     shuffle_partition_bytes: int = 192 * 1024 * 1024,
                     split_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run: shuffle partitions so one holds about ``shuffle_partition_bytes``
    of the largest *shuffle* (not of the input: reports shuffle aggregates), in whole waves of
    ``total_cores``, at most ``MAX_SHUFFLE_PARTITIONS``; scan splits of ``split_bytes``; AQE allowed to
    coalesce small partitions and split skewed ones; Arrow batches bounded in bytes.

    Pass the result as ``build_session(extra=...)``.
    """
    wanted = max(1, -(-shuffled_bytes // shuffle_partition_bytes))
    waves = max(1, -(-wanted // total_cores))
    most = max(1, MAX_SHUFFLE_PARTITIONS // total_cores)
    return {
        "spark.sql.shuffle.partitions": str(min(waves, most) * total_cores),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    }
