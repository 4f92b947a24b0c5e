"""Shared scratch folder for tables that a job writes and reads again."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the runs under way, the innermost last.
_runs: list[str] = []


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    base = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.conf.get("spark.master", "local")
    own_disk = base.startswith("file:") or ":" not in base
    if own_disk and not (master == "local" or master.startswith("local[")):
        raise ValueError(
            "scratch tables need a folder that driver and executors share: set spark.checkpoint.dir "
            f"(the warehouse {base} is a folder of one machine)"
        )
    return base.rstrip("/") + "/scratch"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, within the run under way if there is one.

    A session that names no such folder gets one below its warehouse
    (``spark.sql.warehouse.dir``), unless executors on other machines could not see that.
    """
    base = _runs[-1] if _runs else _base(spark)
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Scratch tables written meanwhile stand in one folder, which is removed in the end.

    Results must have been written elsewhere by then, as they read these tables.
    """
    folder = f"{_base(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run meanwhile go when their query ends.

    Else they stay until the driver happens to collect its garbage, and a job of many writes keeps them all.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs at most the work done since.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark, purpose)}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
