import pytest

from tabula.operators.runlog import KEY_VALUE, METRICS
from tabula.operators.runsearch import Condition as C
from tabula.operators.runsearch import Order, SearchError, search


@pytest.fixture(scope="module")
def log(spark):
    runs = spark.createDataFrame(
        [("r1", "one", "FINISHED", 30), ("r2", "two", "FAILED", 20), ("r3", None, "FINISHED", 10), ("r4", "One", "RUNNING", 40)],
        "run_id string, run_name string, status string, start_time long",
    )
    metrics = spark.createDataFrame(
        [("r1", "m", 1, 5.0, 0), ("r1", "m", 2, 1.0, 1), ("r2", "m", 1, 3.0, 0), ("r3", "m", 1, float("nan"), 0), ("r2", "k", 1, 7.0, 0)], METRICS
    )
    tags = spark.createDataFrame([("r1", "branch", "a"), ("r2", "branch", "b"), ("r3", "sha", "x"), ("r1", "sha", "x")], KEY_VALUE)
    params = spark.createDataFrame([("r1", "depth", "8"), ("r4", "depth", "4"), ("r2", "depth", None)], KEY_VALUE)
    return {"runs": runs, "metrics": metrics, "tags": tags, "params": params}


def ids(df):
    return [r.run_id for r in df.collect()]


def found(log, *conditions):
    return sorted(ids(search(log["runs"], conditions, metrics=log["metrics"], tags=log["tags"], params=log["params"])))


def test_conditions_of_each_kind(log):
    assert found(log) == ["r1", "r2", "r3", "r4"]
    assert found(log, C("attribute", "status", "=", "FINISHED"), C("attribute", "start_time", ">", 10)) == ["r1"]
    assert found(log, C("attribute", "run_name", "like", "o%")) == ["r1"] and found(log, C("attribute", "run_name", "ilike", "o%")) == ["r1", "r4"]
    assert found(log, C("attribute", "status", "in", ["FAILED", "RUNNING"])) == ["r2", "r4"]
    assert found(log, C("tag", "branch", "!=", "a")) == ["r2"]  # a run without the tag does not match
    assert found(log, C("tag", "sha", "=", "x"), C("tag", "branch", "not in", ["b"])) == ["r1"]
    assert found(log, C("metric", "m", ">", 2)) == ["r2", "r3"]  # the latest value counts; NaN is the largest
    assert found(log, C("metric", "m", "<=", 3), C("metric", "k", ">=", 7.0)) == ["r2"]
    assert found(log, C("param", "depth", "like", "%")) == ["r1", "r4"]
    assert found(log, C("param", "depth", "=", "8"), C("tag", "sha", "=", "x"), C("metric", "m", "=", 1.0), C("attribute", "start_time", "<", 31)) == ["r1"]


def test_order_and_limit(log):
    tables = {k: log[k] for k in ("metrics", "tags", "params")}
    assert ids(search(log["runs"], order_by=[Order("attribute", "start_time", False)], limit=2)) == ["r4", "r1"]
    assert ids(search(log["runs"], order_by=[Order("metric", "m")], **tables)) == ["r1", "r2", "r3", "r4"]
    assert ids(search(log["runs"], order_by=[Order("param", "depth"), Order("attribute", "start_time")], **tables)) == ["r4", "r1", "r3", "r2"]
    out = search(log["runs"], order_by=[Order("tag", "branch", False)], limit=1, **tables)
    assert out.columns == log["runs"].columns and ids(out) == ["r2"]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_what_cannot_be_asked_for(log):
    for bad in (
        C("attribute", "nowhere", "=", "x"), C("place", "a", "=", "b"), C("metric", "m", "like", "1%"), C("tag", "a", "<", "b"),
        C("attribute", "start_time", ">", "x"), C("metric", "m", ">", True), C("tag", "a", "in", []), C("tag", "a", "=", 1),
    ):
        with pytest.raises(SearchError):
            found(log, bad)
    with pytest.raises(SearchError):
        search(log["runs"], [C("tag", "a", "=", "b")])
    with pytest.raises(SearchError):
        search(log["runs"], order_by=[Order("metric", "m")])


def test_one_semi_join_per_kind(log):
    many = [C("tag", "branch", "!=", f"v{i}") for i in range(20)]
    plan = search(log["runs"], many, tags=log["tags"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # the tags of the runs asked for, and the runs that have them


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_kind_starts_from_the_runs_left(log):
    """Two joins in the last plan, whatever the kinds before, and partitions that are not merged."""
    tables = {k: log[k] for k in ("metrics", "tags", "params")}
    asked = [C("tag", "sha", "=", "x"), C("param", "depth", "=", "8"), C("metric", "m", "=", 1.0)]
    out = search(log["runs"], asked, **tables)
    assert ids(out) == ["r1"]
    assert _plan(out).count("LeftSemi") == 2 and _plan(out).count("RepartitionByExpression") >= 1
    assert "hashpartitioning(run_id" in (text := out._jdf.queryExecution().executedPlan().toString()) and "REPARTITION_BY_NUM" in text


def test_an_order_starts_from_the_runs_left(log):
    out = search(log["runs"], [C("metric", "m", ">", 0)], metrics=log["metrics"], order_by=[Order("metric", "m", False)], limit=2)
    assert ids(out) == ["r3", "r2"]
    assert _plan(out).count("LeftSemi") == 1  # the metrics of the runs left, to order by
