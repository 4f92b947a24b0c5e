"""A third of all orders belongs to one customer: results stay whole and right."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from caregauge.operators.intervals import enrollment_gaps, split_windows
from tests.test_oracle_parity import FOLDER, ORACLES, QUERIES, TABLES, ordered

SKEWED = [
    "measure_aab", "measure_pcr", "measure_spd", "measure_cdc", "measure_awv", "pdc",
    "stockpile_shift", "elig_per_event", "join_interval_lookback", "readmit_30d",
    "decouple_windows_gaps", "agg_count_distinct",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for name in TABLES:
        source = f"SELECT * FROM '{FOLDER}/{name}.parquet'"
        if name == "orders":
            source = (
                "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END "
                f"AS o_custkey) FROM '{FOLDER}/orders.parquet'"
            )
        connection.execute(f"COPY ({source}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, connection


@pytest.mark.parametrize("name", SKEWED)
def test_hot_member_parity(spark, skewed, name):
    folder, connection = skewed
    result = QUERIES[name](spark, folder)
    cursor = connection.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert ordered(result.collect(), result.columns) == ordered(cursor.fetchall(), columns)


def test_windows_see_days_not_rows(spark):
    """Half a million spans of one member reach the windows as at most one row per day."""
    start = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    spans = spark.range(500_000).select(
        F.lit("hot").alias("member_id"),
        start.alias("date_start"),
        F.date_add(start, (F.col("id") % 7).cast("int")).alias("date_end"),
        F.lit("Y").alias("cover_medical"),
    )
    gaps = enrollment_gaps(spans, F.lit("2018-01-01").cast("date"), F.lit("2018-12-31").cast("date"))
    row = gaps.collect()[0]
    assert (row["gap_count"], row["largest_gap"]) == (1, 59)
    assert split_windows(spans, "member_id").count() <= 307


def test_entry_lists_the_same_queries():
    assert set(SKEWED) <= set(__spark_entry__.queries())
