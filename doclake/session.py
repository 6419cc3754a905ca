"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a cluster deployment is expected to carry as well. They are only
# applied when the caller builds the session through ``get_session``.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges small shuffle partitions towards the advisory size and splits
    # skewed ones, so the count is set for the largest stage (it does not split
    # an aggregation): raise it with the data, ``shuffle_partitions``
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # map state and timers of the streaming jobs
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No join is broadcast by hand: the planner's threshold and AQE's runtime
    # conversion (on measured sizes) decide.
}


def get_session(master: str | None = None, app: str = "doclake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    Without ``master`` the deployment decides (spark-submit, spark-defaults);
    local runs name theirs, e.g. ``local[8]``. Driver memory is the
    deployment's as well, unless given in ``extra``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the deployment and we only read
    it; there it must be set, since no other machine sees a local folder. On a
    local master a fresh scratch folder is made.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="doclake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (streaming state, cut tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
