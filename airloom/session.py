"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results, so every job applies them (runtime-settable).
RESULT_SETTINGS = {
    # Readings are UTC instants; zone-less strings are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # `mode("overwrite")` replaces only the dates present in the frame.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The `date=` partition value is a STRING column, never inferred as DATE.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Largest per-group limit that is applied before the shuffle as well.
GROUP_LIMIT = 100_000

# Settings for the physical plan at scale (runtime-settable as well).
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin with so many partitions, and small ones are merged: what
    # a task sorts follows the advisory size, not the size of the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    # A station or city holding a large share of rows is split by AQE.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # row_number() <= n keeps a partial limit before the shuffle up to this
    # n; a larger n gives the same rows by a plan that ships whole groups.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(GROUP_LIMIT),
    # Many small landed files are packed into one task each.
    "spark.sql.files.openCostInBytes": str(4 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting and plan settings to an existing session."""
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "airloom",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings used by tests and bench.

    ``master=None`` keeps the master given by ``spark-submit`` (or Spark's
    local default when there is none).
    """
    builder = SparkSession.builder
    if master is not None:
        builder = builder.master(master)
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return configure(spark)


# Scratch folder of each local application that names none.
_LOCAL_ROOTS: dict[str, str] = {}


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no local context
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root named by ``spark.checkpoint.dir``.

    A session on one machine (a test or a laptop run) that names none gets
    a local folder of its own. On a cluster that would be another folder on
    every machine, so there the setting is required.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        root = _LOCAL_ROOTS.setdefault(sc.applicationId, "") or tempfile.mkdtemp(
            prefix="airloom-scratch-"
        )
        _LOCAL_ROOTS[sc.applicationId] = root
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch root for one job's output."""
    return f"{shared_dir(spark)}/airloom/{name}-{uuid.uuid4().hex[:12]}"
