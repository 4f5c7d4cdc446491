"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHARED_KEY = "spark.checkpoint.dir"
_CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list[str] = []

# Settings every deployment wants; shuffle partitions and memory stay with the cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "wattlane",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def package_for_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver has it.

    On a cluster the package is installed or sent along (``--py-files``); an absent folder does no harm.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path]))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's own setting, or a local one if unset.

    A machine-local folder is used in local mode only; elsewhere the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SHARED_KEY, None) or context.getCheckpointDir()
    if not folder:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError(f"set {_SHARED_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wattlane-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/wattlane-{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has made below the shared folder.

    Results that still read them must have been written or collected before.
    """
    while _made:
        _delete(spark, _made.pop())


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Delete the intermediate tables of this process that ``frames`` scan.

    Called when what was made of them has been written, so that no later job, a retried one neither, reads them.
    """
    for df in frames:
        read = {file.rsplit("/", 2)[-2] for file in df.inputFiles()}
        for path in [p for p in _made if p.rsplit("/", 1)[-1] in read]:
            _made.remove(path)
            _delete(df.sparkSession, path)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it.

    Used where a result is read more than once, or where values that are fixed only at run
    time (such as the range partition a row landed in) must not change on a retry.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # The write is the only run of this plan, so its shuffle files can go with it.
    before = spark.conf.get(_CLEAN_KEY)
    spark.conf.set(_CLEAN_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], spark: SparkSession, label: str = "stage") -> DataFrame:
    """What ``make`` gives, written; the intermediate tables that it made on the way are deleted."""
    before = set(_made)
    result = materialize(make(), label)
    own = {file.rsplit("/", 2)[-2] for file in result.inputFiles()}
    for path in [p for p in _made if p not in before and p.rsplit("/", 1)[-1] not in own]:
        _made.remove(path)
        _delete(spark, path)
    return result


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
