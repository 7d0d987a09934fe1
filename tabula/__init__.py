"""tabula: a Spark-native tabular feature, split, scoring and run-log library.

Every operator is a ``DataFrame -> DataFrame`` function (or a small driver-side
decision over a bounded aggregate). Catalyst, AQE and Spark ML do the work.
"""

from tabula.operators.clean import coerce_numeric, fill_constant, fill_mean, fill_median, normalize_missing
from tabula.operators.evaluate import class_report, metrics_long
from tabula.operators.features import category_codes, fit_one_hot, preprocess
from tabula.operators.runlog import RunStore
from tabula.operators.snapshot import snapshot_diff
from tabula.operators.split import exact_sample, exact_split, hash_split, train_test
from tabula.plans.pipeline import prepare, score_alias, train_register
from tabula.session import build_session
from tabula.sources import read_csv_text
from tabula.spec import BOOKINGS, FeatureSpec

__all__ = [
    "BOOKINGS",
    "FeatureSpec",
    "RunStore",
    "build_session",
    "category_codes",
    "class_report",
    "coerce_numeric",
    "exact_sample",
    "exact_split",
    "fill_constant",
    "fill_mean",
    "fill_median",
    "fit_one_hot",
    "hash_split",
    "metrics_long",
    "normalize_missing",
    "prepare",
    "preprocess",
    "read_csv_text",
    "score_alias",
    "snapshot_diff",
    "train_register",
    "train_test",
]
