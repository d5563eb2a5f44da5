"""Session settings and the shared scratch location.

Jobs read the checkpoint directory the cluster names in ``spark.checkpoint.dir``
(or an already set ``SparkContext`` checkpoint dir). Only when neither is set, as in
local tests, do we pick a directory of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Shuffle partition counts are left to the caller:
# with AQE on, a high initial count is coalesced at run time to the measured size.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from file-size estimates (compressed parquet can grow many times in memory).
    # Broadcasts come from AQE, once the measured shuffle output of a side is under the adaptive
    # threshold (compressed bytes: in memory a side may take several times as much).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    # Checkpoint files are removed once no plan refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "circulation") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings above that a running session accepts (the cleaner setting only applies at start-up).
RUNTIME_SQL_CONF = {k: v for k, v in SESSION_CONF.items() if k.startswith("spark.sql.")}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to a session someone else built (time zone, AQE, broadcast policy)."""
    for key, value in RUNTIME_SQL_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only where none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster: checkpoints and "
                "scratch data must survive the loss of an executor"
            )
        # Unset on a local run, such as a test: a folder of our own.
        configured = tempfile.mkdtemp(prefix="circulation-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back: computed once, kept on
    the loss of an executor, and scanned with column pruning afterwards."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
