"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are still unset, so cluster-provided values (shuffle
partitions, checkpoint dir, AQE) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we want unless the cluster already decided otherwise.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "rankforge") -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.driver.memory", os.environ.get("RANKFORGE_DRIVER_MEM", "8g"))
         .config("spark.sql.files.maxPartitionBytes", str(64 << 20)))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there.  Only a session whose tasks run in
    this process may fall back to a scratch folder; anywhere else a folder of
    this machine would be lost on the others, so the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="rankforge-ckpt-")
        try:      # informational: some deployments reject core confs at runtime
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut lineage of a small, reused intermediate (one row per participant
    or per env subset) with a reliable checkpoint in the shared folder, so
    the scalar subqueries and joins that reuse it do not recompute the scan,
    and a lost executor does not force a recompute from the raw log."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
