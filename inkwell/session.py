"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Everything the library needs from a session. Partition counts are left to the cluster: AQE
# coalesces small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", app_name: str = "inkwell") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests, the benchmark) gets a folder of its own; any other raises.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        path = tempfile.mkdtemp(prefix="inkwell-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below :func:`shared_dir`, so that a run never overwrites what it reads."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: they stay the same whichever executors are lost."""
    path = run_dir(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
