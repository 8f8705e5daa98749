"""Session building and the few session facts operators depend on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rastro", cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators are tested under (UTC, AQE, ANSI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a private one only where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share: intermediate results must survive the loss of any of them")
        folder = f"file://{tempfile.mkdtemp(prefix='rastro-')}"
        atexit.register(shutil.rmtree, folder.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def passing_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage; survives the loss of any executor.

    The files go with the result if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as in :func:`build_session`.
    """
    spark = df.sparkSession
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, where neither their path nor their folder has it already."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    on_path = [Path(p or ".").resolve() for p in (*os.environ.get("PYTHONPATH", "").split(os.pathsep), "")]
    if root in on_path or getattr(context, "_rastro_shipped", False):
        return
    place = tempfile.mkdtemp(prefix="rastro-package-")  # read by the driver's file server only
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    with zipfile.ZipFile(f"{place}/rastro.zip", "w") as archive:
        for file in sorted((root / "rastro").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(f"{place}/rastro.zip")
    context._rastro_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One test table."""
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in enough partitions for work that is heavy on CPU; rows are moved only if the scan gives too few."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(4 * cores, key)
