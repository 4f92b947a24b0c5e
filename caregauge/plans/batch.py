"""All measures as a job that can be started again: load, measure, save, combine, compare."""

from __future__ import annotations

import datetime
import hashlib
import json
import time
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caregauge.operators.output import combine_results, measure_rates, rates_against_target
from caregauge.plans.run import measure_calls, shared_inputs
from caregauge.sources.scratch import scratch_run
from caregauge.sources.tables import load_tables, save_result

MANIFEST = "manifest.parquet"


def run_key(
    tables: Mapping[str, DataFrame],
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
    follow_up: Mapping[str, object] | None,
) -> str:
    """Names what a result was made of: the files of every table and the parameters."""
    files = {name: sorted(df.inputFiles()) for name, df in sorted(tables.items())}
    parameters = [str(performance_yearstart), str(date_latestpaid), follow_up]
    return hashlib.sha256(json.dumps([files, parameters], sort_keys=True, default=str).encode()).hexdigest()


def finished(spark: SparkSession, folder: str, key: str) -> set[str]:
    """Measures whose latest entry in the manifest of ``folder`` has this key."""
    try:
        rows = spark.read.parquet(f"{folder}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    latest = rows.groupBy("measure").agg(F.max_by("key", "at").alias("key"))
    return {row["measure"] for row in latest.where(F.col("key") == key).collect()}


def _enter(spark: SparkSession, folder: str, name: str, key: str) -> None:
    row = spark.createDataFrame([(name, key, time.time())], "measure string, key string, at double")
    row.coalesce(1).write.mode("append").parquet(f"{folder}/{MANIFEST}")


def run_batch(
    spark: SparkSession,
    paths: Mapping[str, str],
    folder: str,
    performance_yearstart: datetime.date,
    date_latestpaid: datetime.date,
    catalogue: DataFrame | None = None,
    follow_up: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rates of all measures, next to their targets where a ``catalogue`` is given.

    Each measure's rows are written to ``folder`` (``results_<name>.parquet``) and then listed in
    its manifest, one row a measure. A job that ended early and is started again over the same files
    with the same parameters makes only the measures that are missing; other files or parameters
    make all anew. The stacked rows (``combined.parquet``) and the rates (``rates.parquet``) are
    written in the end. Scratch tables of the run are removed.
    """
    tables = load_tables(spark, paths)
    key = run_key(tables, performance_yearstart, date_latestpaid, follow_up)
    calls = measure_calls(performance_yearstart, date_latestpaid, follow_up)
    done = finished(spark, folder, key)
    missing = [name for name in calls if name not in done]
    if missing:
        with scratch_run(spark):
            inputs = shared_inputs(tables, performance_yearstart, date_latestpaid)
            for name in missing:
                _enter(spark, folder, name, "under way")
                save_result(calls[name](inputs), folder, name)
                _enter(spark, folder, name, key)
    results = [spark.read.parquet(f"{folder}/results_{name}.parquet") for name in calls]
    combine_results(results).write.mode("overwrite").parquet(f"{folder}/combined.parquet")
    rates = measure_rates(spark.read.parquet(f"{folder}/combined.parquet"))
    if catalogue is not None:
        rates = rates_against_target(rates, catalogue)
    rates.write.mode("overwrite").parquet(f"{folder}/rates.parquet")
    return spark.read.parquet(f"{folder}/rates.parquet")
