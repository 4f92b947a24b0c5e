"""The restartable job and the life of its scratch tables."""

import time

import pytest

from caregauge.plans import batch, run
from caregauge.sources import scratch
from caregauge.sources.scratch import scratch_run, stored
from checks import claim_model as model

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    tables = model.tables(spark, FOLDER)
    for name in tables:
        tables[name].write.parquet(f"{folder}/{name}.parquet")
    return {name: f"{folder}/{name}.parquet" for name in tables}


def made(monkeypatch, stop_after=None):
    """Names of the measures that were saved; fails after some."""
    names = []

    def save(result, folder, name):
        if len(names) == stop_after:
            raise RuntimeError("lost")
        names.append(name)
        return save_result(result, folder, name)

    save_result = batch.save_result.__wrapped__ if hasattr(batch.save_result, "__wrapped__") else batch.save_result
    save.__wrapped__ = save_result
    monkeypatch.setattr(batch, "save_result", save)
    return names


def test_a_stopped_job_goes_on(spark, paths, tmp_path, monkeypatch):
    out, dates = str(tmp_path / "out"), (model.PY, model.LATEST_PAID)
    first = made(monkeypatch, stop_after=5)
    with pytest.raises(RuntimeError, match="lost"):
        batch.run_batch(spark, paths, out, *dates)
    second = made(monkeypatch)
    rates = batch.run_batch(spark, paths, out, *dates)
    everything = list(run.measure_calls(*dates))
    assert len(first) == 5 and first + second == everything

    want = run.run_all(model.tables(spark, FOLDER), *dates)
    combined = spark.read.parquet(f"{out}/combined.parquet")
    assert sorted(map(str, combined.collect())) == sorted(map(str, want.select(combined.columns).collect()))
    reported = rates.count()
    assert reported == want.select("comp_quality_short").distinct().count() > 20

    third = made(monkeypatch)  # nothing is left to do
    assert batch.run_batch(spark, paths, out, *dates).count() == reported and third == []
    # other parameters are another job, and what it overwrites must be made anew
    tables = batch.load_tables(spark, paths)
    mine, other = (batch.run_key(tables, *dates, more) for more in (None, {"source": "x"}))
    assert batch.finished(spark, out, mine) == set(everything) and batch.finished(spark, out, other) == set()
    batch._enter(spark, out, "CDC", other)
    batch._enter(spark, out, "MMA", "under way")
    assert batch.finished(spark, out, mine) == set(everything) - {"CDC", "MMA"}


def test_scratch_tables_of_a_run_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_base", lambda spark: str(tmp_path))
    with pytest.raises(RuntimeError), scratch_run(spark) as outer:
        with scratch_run(spark):
            assert stored(spark.range(3), "x").count() == 3
        assert stored(spark.range(4), "y").count() == 4 and outer.startswith(str(tmp_path))
        raise RuntimeError
    assert list(tmp_path.iterdir()) == []


class Session:
    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


@pytest.mark.parametrize(
    "settings, folder",
    [
        ({"spark_master": "local[8]", "spark.sql.warehouse.dir": "file:/w"}, "file:/w/scratch"),
        ({"spark_master": "yarn", "spark.sql.warehouse.dir": "hdfs://n/w/"}, "hdfs://n/w/scratch"),
        ({"spark_master": "yarn", "spark.sql.warehouse.dir": "file:/w", "spark.checkpoint.dir": "/shared/"}, "/shared"),
        ({"spark_master": "spark://h:7077", "spark.sql.warehouse.dir": "file:/w"}, None),
        ({"spark_master": "local-cluster[2,1,1024]", "spark.sql.warehouse.dir": "/w"}, None),
    ],
)
def test_folders_of_one_machine_are_refused(settings, folder):
    session = Session(**settings)
    if folder:
        assert scratch._base(session) == folder
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch._base(session)


def test_the_shuffles_of_a_measure_go_with_its_write(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    counts = spark.range(2000).selectExpr("id % 7 AS k").groupBy("k").count()
    before, setting = shuffles(), spark.conf.get(scratch.DROP_SHUFFLES, None)
    written = run.of_each({"a": counts, "b": counts.where("k > 2")}, lambda name, result: stored(result, name))
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(scratch.DROP_SHUFFLES, None) == setting
    assert [df.count() for df in written] == [7, 4]
