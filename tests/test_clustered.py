"""Tables in buckets of the member: no exchange by member, and the same results."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from caregauge.plans import MPM3, PBH, SPD
from caregauge.sources import clustered
from checks import claim_model as model

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fresh() -> str:
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    tables, folder = model.tables(spark, FOLDER), tmp_path_factory.mktemp("clustered")
    out = {name: tables[name] for name in ("reference", "ndc")}
    for name in ("claims", "rx_claims", "member", "member_time"):
        out[name] = clustered.save_clustered(tables[name], f"file:{folder}/{name}", fresh(), 4)
    return out


@pytest.mark.parametrize("measure", [MPM3, PBH, SPD])
def test_same_results(spark, bucketed, measure):
    want = measure().calc_measure(model.tables(spark, FOLDER), model.PY)
    got = measure().calc_measure(bucketed, model.PY)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_claims_are_not_exchanged_by_member(spark, bucketed):
    """Only exchanges of code and drug tables (broadcast) are left in a measure over buckets."""
    plain, got = (MPM3().calc_measure(t, model.PY) for t in (model.tables(spark, FOLDER), bucketed))
    assert "hashpartitioning(member_id" in plan_of(plain)
    assert "hashpartitioning(member_id" not in plan_of(got)


def test_windows_start_from_the_scan(spark, bucketed):
    claims = bucketed["claims"].groupBy("member_id").agg(F.max("fromdate"))
    joined = claims.join(bucketed["member"], "member_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_found_again_under_another_name(spark, tmp_path):
    rows = [(f"m{k % 50}" if k % 9 else None, k, datetime.date(2018, 1, 1)) for k in range(500)]
    df = spark.createDataFrame(rows, "member_id string, `n o` int, d date")
    clustered.save_clustered(df, f"file:{tmp_path}/t", fresh(), 4)
    again = clustered.open_clustered(spark, f"file:{tmp_path}/t", fresh())
    assert again.schema == df.schema and again.count() == 500 and again.exceptAll(df).count() == 0
    assert "Exchange" not in plan_of(again.groupBy("member_id").count())


def test_a_hot_member_is_not_put_into_one_bucket(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("member_id"), "id")
    assert clustered.unevenness(df, "member_id", 30) > 9
    got = clustered.save_clustered(df, f"file:{tmp_path}/hot", fresh(), 30)
    assert got.exceptAll(df).count() == 0 and got.count() == 3000
    assert "Exchange" in plan_of(got.groupBy("member_id").count())
    even = clustered.save_clustered(df.where("member_id <> 'hot'"), f"file:{tmp_path}/hot", fresh(), 30)  # written over
    assert even.count() == 2000 and "Exchange" not in plan_of(even.groupBy("member_id").count())


def test_empty_and_plain_folders(spark, tmp_path):
    empty = spark.createDataFrame([], "member_id string, id long")
    assert clustered.save_clustered(empty, f"file:{tmp_path}/e", fresh(), 4).count() == 0
    spark.range(5).write.parquet(f"file:{tmp_path}/plain")
    assert clustered.open_clustered(spark, f"file:{tmp_path}/plain", fresh()).count() == 5
