import pytest

from tabula.operators import evaluate

GOLD = [("Canceled", "Canceled", 86), ("Canceled", "Not_Canceled", 35), ("Not_Canceled", "Canceled", 28),
        ("Not_Canceled", "Not_Canceled", 214)]


def gold_frame(spark):
    rows = [(y, p) for y, p, n in GOLD for _ in range(n)]
    return spark.createDataFrame(rows, "label string, prediction string")


def test_recorded_metrics(spark):
    df = gold_frame(spark)
    assert evaluate.accuracy(df, "label", "prediction").first().accuracy == pytest.approx(0.8264462809917356, abs=1e-15)
    rep = {r["class"]: r for r in evaluate.class_report(df, "label", "prediction").collect()}
    assert rep["Canceled"].precision == pytest.approx(0.7543859649122807, abs=1e-15)
    assert rep["Canceled"].recall == pytest.approx(0.7107438016528925, abs=1e-15)
    assert rep["Canceled"].f1_score == pytest.approx(0.7319148936170212, abs=1e-15)
    assert rep["Not_Canceled"].precision == pytest.approx(0.8594377510040161, abs=1e-15)
    assert rep["Not_Canceled"].recall == pytest.approx(0.8842975206611571, abs=1e-15)
    assert rep["Not_Canceled"].f1_score == pytest.approx(0.8716904276985743, abs=1e-15)
    assert (rep["Canceled"].support, rep["Not_Canceled"].support) == (121, 242)
    assert rep["macro avg"].support == 363
    m = {r.key: r.value for r in evaluate.metrics_long(df, "label", "prediction", "Not_Canceled").collect()}
    assert m["f1_not_canceled"] == pytest.approx(0.8716904276985743) and m["f1_Not_Canceled"] == m["f1_not_canceled"]
    assert len(m) == 8
    assert evaluate.f1_for(df, "label", "prediction", "Not_Canceled").first().f1 == pytest.approx(0.8716904276985743)


def test_class_never_predicted_and_single_class(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "b")], "label string, prediction string")
    rep = {r["class"]: r for r in evaluate.class_report(df, "label", "prediction").collect()}
    assert rep["a"].precision == 0.0 and rep["a"].f1_score == 0.0
    one = spark.createDataFrame([("a", "a")], "label string, prediction string")
    assert evaluate.accuracy(one, "label", "prediction").first().accuracy == 1.0


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "label string, prediction string")
    assert evaluate.accuracy(empty, "label", "prediction").first().accuracy == 0.0
    assert evaluate.f1_for(empty, "label", "prediction", "x").first().f1 == 0.0
