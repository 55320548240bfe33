"""The extract built in steps: same rows, a step's shuffle files and the steps it
replaces are gone when the next begins."""

import datetime as dt
import tempfile
import time
from decimal import Decimal as D

import pytest

from kredex.params import RunParams
from kredex.plans.extract import build_extract
from kredex.session import Scope, folders
from kredex.sources.collation import CASE_INSENSITIVE
from kredex.sources.tables import TableSource
from test_micro_fixture import CUT, write_fixture
from test_runtime_filter import with_filter  # noqa: F401


@pytest.fixture(scope="module")
def src(spark):
    root = tempfile.mkdtemp(prefix="kredex-steps-") + "/src"
    write_fixture(spark, root)
    # a second balance row and universe row of each loan: joins fan out alike
    for name in ("saldos", "universe"):
        spark.read.parquet(f"{root}/{name}").where("jts_oid % 2 = 0").write.parquet(f"{root}/{name}-more")
        spark.read.parquet(f"{root}/{name}-more").write.mode("append").parquet(f"{root}/{name}")
    return TableSource(spark, root, cutoff=dt.date(2018, 10, 31), collation=CASE_INSENSITIVE)


@pytest.fixture
def p():
    return RunParams(cutoff=CUT, tc=D("32.1234"), version="1")


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def names(spark, scope):
    return sorted(path.rsplit("/", 1)[1].split("-")[0] for path, _ in folders(spark, scope.folder))


def test_steps_give_the_rows_of_one_plan(spark, src, p):
    want = sorted(map(str, build_extract(src, p, checked=True).collect()))
    with Scope(spark) as scope:
        got = build_extract(src, p, checked=True, scope=scope)
        assert names(spark, scope) == ["lookups", "schedules"]
        assert sorted(map(str, got.collect())) == want and len(want) > 15
    assert folders(spark, scope.folder) == []


def test_a_steps_shuffle_files_are_freed(spark):
    with Scope(spark) as scope:
        before = shuffle_files(spark)
        step = scope.step(spark.range(1000).repartition(7, "id"), "x")
        until = time.time() + 30
        while shuffle_files(spark) > before and time.time() < until:
            time.sleep(0.2)
        assert shuffle_files(spark) <= before
        assert step.rows.count() == 1000


def test_children_are_filtered_in_steps_too(spark, src, p, with_filter, monkeypatch):  # noqa: F811
    """The loans read from a step are a filtered side, of which Spark builds the
    runtime filter of a child table."""
    plans, write = {}, Scope.step
    monkeypatch.setattr(Scope, "step", lambda self, df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or write(self, df, name))
    with_filter(True)
    with Scope(spark) as scope:
        build_extract(src, p, scope=scope)
    assert sorted(plans) == ["balances", "history", "lookups", "schedules"]
    assert all("might_contain" in plans[x] for x in ("history", "schedules"))


def test_queries_free_the_extract_before_they_use_it(spark, sf_dir, monkeypatch):
    """Text and table are written from the written extract, not beside its shuffles."""
    import __spark_entry__ as E
    from kredex.plans import publish
    seen = []
    export = publish.export_text
    monkeypatch.setattr(publish, "export_text", lambda rows, path: seen.append(
        rows._jdf.queryExecution().executedPlan().toString()) or export(rows, path))
    assert E.queries()["export_text_round_trip"](spark, sf_dir).count() > 0
    assert "Exchange" not in seen[0]
