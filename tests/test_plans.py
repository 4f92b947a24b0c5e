"""Shape of the physical plans: what must not happen at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from caregauge.operators import valuesets
from caregauge.plans import run
from caregauge.plans.common import two_or_more
from caregauge.sources import scratch
from checks import claim_model
from checks.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
ALL = sorted(QUERIES)
# Writes files before it returns its plan; its plan is checked by the parity test.
WRITERS = {
    "src_schema_csv", "src_reference_catalogue", "src_reference_part", "src_reference_supplier", "src_reference_builtin",
    "src_clustered_table",
    "combine_results", "combine_all_results",
}
# Scans of the line items, from which claims and pharmacy fills are derived.
LINE_SCANS = {
    "measure_mpm3": 2, "measure_pbh": 2, "measure_pcr": 1, "measure_cis": 1, "measure_awv": 1,
    "measure_aab": 2, "measure_spd": 3, "measure_spc": 3, "measure_cdc": 2, "measure_mma": 3, "run_all": 0,
    "value_set_match": 1, "elig_per_event": 0,
}




def plan_of(spark, name: str) -> str:
    df = __spark_entry__.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in ALL if name not in WRITERS])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(("name", "expected"), LINE_SCANS.items())
def test_claims_and_fills_are_not_read_again(spark, name, expected):
    """Claims once; fills once, or twice where flags and covered days both need them."""
    scans = [line for line in plan_of(spark, name).splitlines() if "FileScan parquet" in line]
    assert sum("l_orderkey" in line for line in scans) == expected


def test_claim_tables_are_built_once(spark):
    tables = claim_model.tables(spark, FOLDER)
    assert tables["claims"] is tables["claims"]
    assert "nonsense" not in tables and len(tables) == 8


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(ALL) <= set(__spark_entry__.queries())


def line_scans(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan parquet" in line and "l_orderkey" in line for line in plan.splitlines())


def test_all_measures_read_claims_and_fills_once(spark, monkeypatch):
    """What is written for all of them scans the line items twice, and their union not at all."""
    scans = []

    def counted(df, purpose):
        scans.append(line_scans(df))
        return scratch.stored(df, purpose)

    monkeypatch.setattr(run, "stored", counted)
    monkeypatch.setattr(valuesets, "stored", counted)
    everything = run.run_all(claim_model.tables(spark, FOLDER), claim_model.PY, claim_model.LATEST_PAID)
    assert sum(scans) == 2 and line_scans(everything) == 0


def below_first_exchange(plan: str, scan: str) -> list[str]:
    """Operators between each scan of ``scan`` and the exchange above it, lowest first."""
    lines, found = plan.splitlines(), []
    for at, line in enumerate(lines):
        if "FileScan parquet" in line and scan in line:
            above, depth = [], line.index("FileScan")
            for other in reversed(lines[:at]):
                column = len(other) - len(other.lstrip(" :+-*(0123456789)"))
                if column < depth:
                    depth = column
                    above.append(other.strip(" :+-"))
                    if "Exchange" in other:
                        break
            found.append(" / ".join(above))
    return found


def test_asthma_fills_are_picked_before_any_exchange(spark):
    """Only fills of listed drugs are shuffled: each scan of lines meets the drug list first."""
    fills = [path for path in below_first_exchange(plan_of(spark, "measure_mma"), "l_orderkey") if "ndc" in path]
    assert fills and all("Join" in path and "drug_id" in path for path in fills)


def test_only_childrens_claims_are_aggregated(spark):
    path = [p for p in below_first_exchange(plan_of(spark, "measure_cis"), "l_orderkey")]
    assert path and all("LeftSemi" in p for p in path)


def test_wellness_reads_spans_once(spark):
    plan = plan_of(spark, "measure_awv")
    assert sum("date_start" in line and "Generate inline" in line for line in plan.splitlines()) == 1


def test_no_task_runs_several_measures(spark):
    """Stacked plans of the measures would be one stage, and a task of it a partition of each."""
    stacked = plan_of(spark, "run_all")
    assert "FileScan" in stacked
    assert not any(word in stacked for word in ("Join", "Window", "Aggregate", "Exchange"))


def test_asthma_fills_are_dealt_out_before_the_windows(spark):
    """A plain exchange is joined by its bytes, and a task then sorts what it read twice."""
    plan = plan_of(spark, "measure_mma")
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line and "fromdate#" in line and "drug_id#" in line]
    assert dealt and all("8), REPARTITION_BY_NUM" in line for line in dealt)


def test_dates_are_compared_without_sorting(spark):
    """Smallest and largest dates fit a hash aggregate; structs of them would sort all claims of a task."""
    values = [F.col("a"), F.col("b")]
    rows = spark.sql(
        "SELECT k, CAST(a AS DATE) a, CAST(b AS DATE) b FROM VALUES ('same', '2020-01-01', '2020-01-02'), ('same', '2020-01-01', '2020-01-02'), "
        "('first', '2020-01-01', '2020-01-02'), ('first', '2020-01-03', '2020-01-02'), ('second', '2020-01-01', '2020-01-02'), "
        "('second', '2020-01-01', '2020-01-03'), ('null', '2020-01-01', '2020-01-02'), ('null', '2020-01-03', NULL), ('none', NULL, NULL) AS v(k, a, b)"
    )
    found = rows.groupBy("k").agg(two_or_more(*values).alias("two"))
    assert dict(found.collect()) == {"same": False, "first": True, "second": True, "null": False, "none": False}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
