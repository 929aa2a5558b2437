"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC day boundaries (Q23), AQE, dynamic partition overwrite
# for keyed upserts. ANSI mode stays on (Spark 4 default); bad data goes through try_* functions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "obslake",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  ui: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass master=None and let spark-submit decide; tests pass local[N]. The web UI
    stays off unless asked for (ui=True): batch jobs report through event logs instead.
    """
    b = SparkSession.builder.appName(app)
    b = b.config("spark.ui.enabled", "true" if ui else "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    # reliable checkpoints taken by upserts are removed once their data is no longer referenced
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the SQL defaults to an existing session (e.g. one the driver created)."""
    for k, v in DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in spark.checkpoint.dir.

    Read from the session. Only where it is unset and the master is local (tests) is a private
    folder created and registered; on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no driver-side context, read the conf
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        if not d:
            d = tempfile.mkdtemp(prefix="obslake-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables and stream state."""
    return os.path.join(checkpoint_dir(spark), "obslake", f"{name}-{uuid.uuid4().hex[:12]}")
