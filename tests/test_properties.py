"""Property checks of the selection and split invariants (few examples: each is a Spark job)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabula.operators import split
from tabula.operators.select import kth_smallest

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.data())
def test_kth_equals_sorted(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    r = kth_smallest(df, "v", k, fanout=4, max_collect=5)
    assert r.value == sorted(values)[k - 1]
    assert r.n_less == sum(v < r.value for v in values) and r.n_equal == values.count(r.value)


@SETTINGS
@given(st.lists(st.integers(0, 30), min_size=2, max_size=200), st.floats(0.05, 0.95))
def test_exact_split_size_and_partition(spark, ids, ratio):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id long, n long")
    flagged = split.exact_split(df, "id", ratio, 11)
    rows = flagged.collect()
    assert sum(r.is_test for r in rows) == math.ceil(ratio * len(ids))
    assert sorted(r.n for r in rows) == list(range(len(ids)))


@SETTINGS
@given(
    st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.integers(0, 3)), max_size=30),
    st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.integers(0, 3)), max_size=30),
)
def test_snapshot_diff_matches_brute_force(spark, old, new):
    from tabula.operators.snapshot import snapshot_diff

    o = spark.createDataFrame(list(old.items()), "k int, v int")
    n = spark.createDataFrame(list(new.items()), "k int, v int")
    got = sorted((r.k, r._change_type, r.v) for r in snapshot_diff(o, n, ["k"]).collect())
    want = []
    for k in old.keys() | new.keys():
        if k not in old:
            want.append((k, "insert", new[k]))
        elif k not in new:
            want.append((k, "delete", old[k]))
        elif old[k] != new[k]:
            want += [(k, "update_preimage", old[k]), (k, "update_postimage", new[k])]
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5)), min_size=1, max_size=120))
def test_sequence_matches_brute_force(spark, rows):
    import pandas as pd

    from tabula.operators.sequence import sequence_within

    df = spark.createDataFrame([(g, t, i) for i, (g, t) in enumerate(rows)], "g string, t long, i long")
    got = sequence_within(df, ["g"], ["t", "i"], num_partitions=3).toPandas().set_index("i")["seq"].to_dict()
    p = pd.DataFrame([(g, t, i) for i, (g, t) in enumerate(rows)], columns=["g", "t", "i"])
    p["seq"] = p.sort_values(["t", "i"]).groupby("g").cumcount() + 1
    assert got == p.set_index("i")["seq"].to_dict()


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from("xyz")), min_size=1, max_size=80))
def test_class_report_matches_brute_force(spark, pairs):
    from tabula.operators import evaluate

    df = spark.createDataFrame(pairs, "label string, prediction string")
    rep = {r["class"]: r for r in evaluate.class_report(df, "label", "prediction").collect()}
    classes = {c for pair in pairs for c in pair}
    f1s = []
    for c in classes:
        tp = sum(1 for y, p in pairs if y == c and p == c)
        fp = sum(1 for y, p in pairs if y != c and p == c)
        fn = sum(1 for y, p in pairs if y == c and p != c)
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
        f1s.append(f1)
        assert math.isclose(rep[c].precision, prec) and math.isclose(rep[c].recall, rec)
        assert math.isclose(rep[c].f1_score, f1) and rep[c].support == tp + fn
    assert math.isclose(rep["macro avg"].f1_score, sum(f1s) / len(f1s))
    assert rep["weighted avg"].support == len(pairs)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-20, 20)), st.one_of(st.none(), st.floats(-5, 5))),
                min_size=1, max_size=150))
def test_exact_medians_match_brute_force(spark, rows):
    import statistics

    from tabula.operators.select import exact_medians

    df = spark.createDataFrame(rows, "a long, b double")
    got = exact_medians(df, ["a", "b"], fanout=3, max_collect=4)
    for i, c in enumerate(["a", "b"]):
        vals = [r[i] for r in rows if r[i] is not None]
        want = statistics.median(vals) if vals else None
        assert (got[c] is None and want is None) or math.isclose(got[c], want, rel_tol=0, abs_tol=1e-12)
