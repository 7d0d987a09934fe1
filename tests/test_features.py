import math

import pytest
from pyspark.sql import functions as F

from tabula.operators import features
from tabula.spec import BOOKINGS


def booking_rows(n=40):
    rows = []
    for i in range(n):
        rows.append(
            {
                "Booking_ID": f"INN{i:05d}",
                "no_of_adults": str(1 + i % 3),
                "no_of_children": str(i % 2),
                "no_of_weekend_nights": str(i % 3),
                "no_of_week_nights": str(i % 5),
                "type_of_meal_plan": ["Meal Plan 1", "Meal Plan 2", "Not Selected"][i % 3],
                "required_car_parking_space": str(i % 2),
                "room_type_reserved": f"Room_Type {1 + i % 4}",
                "lead_time": str(i * 3),
                "arrival_year": "2018",
                "arrival_month": str(1 + i % 12),
                "arrival_date": str(1 + i % 28),
                "market_segment_type": ["Online", "Offline", "Corporate"][i % 3],
                "repeated_guest": "0",
                "no_of_previous_cancellations": "0",
                "no_of_previous_bookings_not_canceled": "0",
                "avg_price_per_room": "n/a" if i == 3 else f"{80 + i}.5",
                "no_of_special_requests": str(i % 3),
                "booking_status": "Canceled" if i % 3 == 0 else "Not_Canceled",
            }
        )
    return rows


def test_preprocess_column_order_and_types(spark):
    df = spark.createDataFrame(booking_rows())
    out = features.preprocess(df, BOOKINGS, month_col="arrival_month")
    assert out.columns == BOOKINGS.projection and len(out.columns) == 21
    types = dict(out.dtypes)
    assert types["Booking_ID"] == "string" and types["lead_time"] == "double"
    assert out.where(F.col("booking_status").isNull()).count() == 0
    r = out.where(F.col("arrival_month") == 12).first()
    assert abs(r.month_as_sin) < 1e-12 and r.month_as_cos == pytest.approx(1.0)
    assert out.where(F.col("avg_price_per_room").isNull()).count() == 1


def test_preprocess_missing_column(spark):
    df = spark.createDataFrame(booking_rows()).drop("lead_time")
    with pytest.raises(KeyError):
        features.preprocess(df, BOOKINGS, month_col="arrival_month")


def test_dictionary_any_size(spark, monkeypatch):
    from tabula.operators import sequence

    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "c"), (4, "a")], "k int, c string")
    for task_rows in (sequence.TASK_ROWS, 1):  # one task, or ranges over many
        monkeypatch.setattr(sequence.sequence_within, "__defaults__", ("seq", None, task_rows))
        assert [r.c_code for r in features.category_codes(df, ["c"]).orderBy("k").collect()] == [1, 0, -1, 2, 0]


def test_category_of_nan_and_infinity(spark):
    rows = [(0, float("nan")), (1, 2.0), (2, None), (3, float("-inf")), (4, float("inf"))]
    got = features.category_codes(spark.createDataFrame(rows, "k int, d double"), ["d"]).orderBy("k").collect()
    assert [r.d_code for r in got] == [-1, 1, -1, 0, 2]


def test_one_hot_unseen_and_null_at_fit(spark):
    fit_df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    model = features.fit_one_hot(fit_df, ["c"])
    assert model.column_names() == ["c___null__", "c_x", "c_y"]
    score = spark.createDataFrame([("x",), ("zz",), (None,)], "c string")
    rows = [tuple(r) for r in model.transform(score, keep_source=False).collect()]
    assert rows == [(0.0, 1.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)]


def test_age_and_cyclic(spark):
    df = spark.createDataFrame([(2000, 3)], "GarageYrBlt int, m int")
    out = features.add_age(df, "GarageYrBlt", "GarageAge", current_year=2024)
    assert "GarageYrBlt" not in out.columns and out.first().GarageAge == 24
    c = features.add_cyclic(df, "m").first()
    assert c.month_as_sin == pytest.approx(math.sin(2 * math.pi * 3 / 12))


def test_one_hot_many_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 2)], "s string, n int")
    model = features.fit_one_hot(df, ["s", "n"])
    assert model.categories == {"s": ["a", "b"], "n": ["1", "2", "__null__"]}


def test_one_hot_names_never_meet(spark):
    df = spark.createDataFrame([("b_c", "c", "1.0"), ("x", "y", "1_0")], "a string, a_b string, v string")
    model = features.fit_one_hot(df, ["a", "a_b", "v"])
    names = model.column_names()
    assert len(set(names)) == 6 and names[:3] == ["a_b_c", "a_x", "a_b_c__2"]
    row = model.transform(df, keep_source=False).select(*names).where("a_b_c = 1").first()
    assert [row[n] for n in names] == [1.0, 0.0, 1.0, 0.0, 1.0, 0.0]


def test_one_hot_slots_have_no_limit(spark):
    fit_df = spark.range(3000).selectExpr("cast(id as string) as c").unionByName(spark.createDataFrame([(None,)], "c string"))
    score = spark.createDataFrame([("7",), ("none of them",), (None,)], "c string")
    got = {r.c: r.c_slots for r in features.fit_one_hot_slots(fit_df, "c").transform(score).collect()}
    order = sorted([str(i) for i in range(3000)] + [features.NULL_CATEGORY])
    assert got["7"].indices == [order.index("7")] and got["7"].values == [1.0] and got["7"].size == 3001
    assert got["none of them"].indices == [] and got[None].indices == [order.index(features.NULL_CATEGORY)]


def test_category_codes_text_and_numbers(spark):
    df = spark.createDataFrame([(0, "b", 10), (1, "a", 2), (2, None, 1), (3, "b", None)], "k int, s string, n int")
    out = features.category_codes(df, ["s", "n"]).orderBy("k").collect()
    assert [(r.s_code, r.n_code) for r in out] == [(1, 2), (0, 1), (-1, 0), (1, -1)]
