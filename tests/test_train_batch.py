import os

import pytest
from pyspark.sql import functions as F

from tabula.operators import evaluate, features, split, train
from tabula.operators.batch import ModelWrapper, ThresholdModel, score_batches
from tabula.spec import BOOKINGS
from tests.test_features import booking_rows

FAST = train.BoostParams(max_iter=5, max_depth=3, min_instances_per_node=1)


@pytest.fixture(scope="module")
def fitted(spark):
    clean = features.preprocess(spark.createDataFrame(booking_rows(120)), BOOKINGS, month_col="arrival_month")
    tr, te = split.train_test(split.exact_split(clean, "Booking_ID", 0.2, 42))
    model = train.fit(tr, BOOKINGS, FAST)
    return clean, tr, te, model


def test_pipeline_structure(fitted):
    _, _, _, model = fitted
    names = [type(s).__name__ for s in model.stages]
    assert names[-2] == "GBTClassificationModel" and names[-1] == "IndexToString"
    assert model.stages[1].labels == ["Canceled", "Not_Canceled"]


def test_score_without_target_and_extra_columns(spark, fitted):
    clean, tr, te, model = fitted
    contract = train.input_contract(tr, BOOKINGS)
    assert contract.fieldNames()[:2] == ["no_of_adults", "no_of_children"] and len(contract) == 17
    scored = train.score(model, te.drop("booking_status"), BOOKINGS, contract=contract, keep=["Booking_ID"],
                         labels={"Not_Canceled": "Room Reserved", "Canceled": "Room Not Reserved"})
    assert scored.count() == te.count()
    assert {r.prediction_label for r in scored.collect()} <= {"Room Reserved", "Room Not Reserved"}


def test_unseen_category_and_missing_numbers(spark, fitted):
    _, _, te, model = fitted
    odd = te.withColumn("room_type_reserved", F.lit("Room_Type 99")).withColumn("lead_time", F.lit(None).cast("double"))
    assert train.score(model, odd, BOOKINGS).count() == te.count()


def test_save_load_same_predictions(spark, fitted, tmp_dir):
    _, _, te, model = fitted
    path = os.path.join(tmp_dir, "model")
    train.save(model, path)
    again = train.load(path)
    a = sorted(map(tuple, train.score(model, te, BOOKINGS, keep=["Booking_ID"]).collect()))
    b = sorted(map(tuple, train.score(again, te, BOOKINGS, keep=["Booking_ID"]).collect()))
    assert a == b
    m = evaluate.metrics_long(train.score(model, te, BOOKINGS, keep=["booking_status"], out="p"), "booking_status", "p", "Not_Canceled")
    assert m.count() == 8


def test_batch_wrapper(spark):
    df = spark.createDataFrame([(1, 5), (2, 50)], "id long, n long")
    w = ModelWrapper(ThresholdModel("n", 10, "Not_Canceled", "Canceled"), {"Canceled": "Room Not Reserved"})
    got = {r.id: r.prediction for r in score_batches(df, w, ["n"], ["id"]).collect()}
    assert got == {1: "Room Not Reserved", 2: "Not_Canceled"}


def test_fit_does_not_depend_on_the_layout(spark, fitted):
    clean, tr, te, _ = fitted
    got = []
    for n in (1, 5):
        model = train.fit(tr.repartition(n), BOOKINGS, FAST, partitions=3)
        rows = train.score(model, te, BOOKINGS, keep=["Booking_ID"]).collect()
        got.append((sorted(map(tuple, rows)), list(model.stages[-2].featureImportances.toArray())))
    assert got[0] == got[1]


def test_unseen_category_is_a_block_of_zeros(spark, fitted):
    from pyspark.ml.functions import vector_to_array

    _, tr, te, _ = fitted
    model = train.build_features(BOOKINGS).fit(tr)
    odd = te.withColumn("room_type_reserved", F.lit("Room_Type 99")).limit(1)
    sizes = [len(model.stages[2].labelsArray[i]) for i in range(4)]
    v = model.transform(odd).select(vector_to_array("features").alias("v")).first().v
    start = sum(sizes[:2])
    assert set(v[start : start + sizes[2]]) == {0.0} and sum(v[: sum(sizes)]) == 3.0


def test_boosting_may_end_early(spark, fitted):
    _, tr, _, _ = fitted
    params = train.BoostParams(max_iter=200, max_depth=2, min_instances_per_node=1, validation_share=0.2, validation_tol=0.5)
    assert train.fit(tr, BOOKINGS, params, partitions=2).stages[-2].getNumTrees < 200
