"""Session helpers."""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "attestra", cpus: str | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM: executors share the driver's disk."""
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh local one only in local mode where none is set (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the data survives a lost executor and the plan starts anew."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless they find it by themselves: by PYTHONPATH, or by the folder a local session started in."""
    root = pathlib.Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    found = str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or (is_local(spark) and pathlib.Path.cwd() == root)
    if found or app in _shipped:
        return
    with tempfile.NamedTemporaryFile(suffix=".zip", prefix="attestra-", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted((root / "attestra").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(f.name)  # served by the driver, kept by every worker on its path
    _shipped.add(app)
