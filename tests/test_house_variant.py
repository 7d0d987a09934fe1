"""The missing-value variant of the original notebook: mean, median -> age, constants."""

from pyspark.testing import assertDataFrameEqual

from tabula.operators import clean, features


def test_house_cleaning(spark):
    raw = spark.createDataFrame(
        [
            ("1", "65", "2003", "BrkFace", 196.0),
            ("2", "NA", "1976", None, None),
            ("3", "68", "NA", "None", 162.0),
            ("4", "60", "1998", None, 0.0),
        ],
        "Id string, LotFrontage string, GarageYrBlt string, MasVnrType string, MasVnrArea double",
    )
    df = clean.normalize_missing(raw, ["LotFrontage", "GarageYrBlt"])
    df = clean.coerce_numeric(df, ["LotFrontage", "GarageYrBlt"])
    df = clean.fill_mean(df, ["LotFrontage"])
    df = clean.fill_median(df, ["GarageYrBlt"])
    df = features.add_age(df, "GarageYrBlt", "GarageAge", current_year=2024)
    df = clean.fill_constant(df, {"MasVnrType": "None", "MasVnrArea": 0.0})
    df = clean.ids_to_string(df, ["Id"])
    expected = spark.createDataFrame(
        [
            ("1", 65.0, "BrkFace", 196.0, 21.0),
            ("2", 193 / 3, "None", 0.0, 48.0),
            ("3", 68.0, "None", 162.0, 26.0),  # median of 2003, 1976, 1998
            ("4", 60.0, "None", 0.0, 26.0),
        ],
        "Id string, LotFrontage double, MasVnrType string, MasVnrArea double, GarageAge double",
    )
    assertDataFrameEqual(df, expected)
