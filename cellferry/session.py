"""Session set-up and the settings the jobs rely on."""

from __future__ import annotations

import datetime as dt
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings worth having on any cluster. A wide clean-up makes one long generated method, which
# the JVM does not compile beyond 8000 bytes of code; below this limit Spark splits it instead.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # jobs that run side by side get equal shares instead of waiting for one another
    "spark.scheduler.mode": "FAIR",
}


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, use the given one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellferry")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in ADVISED.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    if CHECKPOINT_SETTING.replace(".", "__") not in settings and CHECKPOINT_SETTING not in settings:
        builder = builder.config(CHECKPOINT_SETTING, tempfile.mkdtemp(prefix="cellferry-checkpoint-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session whose
    executors all run in this process gets a folder of its own, as in tests; any other master
    is an error, since a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a shared folder")
        named = tempfile.mkdtemp(prefix="cellferry-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def session_time(spark: SparkSession) -> dt.datetime:
    """The wall-clock time now in the session's time zone, which cursors are compared with."""
    return spark.sql("SELECT CAST(current_timestamp() AS TIMESTAMP_NTZ)").first()[0]
