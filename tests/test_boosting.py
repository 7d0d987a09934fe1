import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import boosting as B

PARAMS = dict(rounds=6, num_leaves=7, max_depth=4, min_child_samples=5, feature_share=1.0, learning_rate=0.3)


def table(spark, n=900, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(), float(rng.integers(0, 6)), str(rng.choice(list("pqrs")))
        odds = 1.5 * (a > 0.3) + (b > 3) * (c == "q") * 2 - 1 + rng.normal() * 0.7
        rows.append((i, None if i % 17 == 0 else a, float("nan") if i % 23 == 0 else b, None if i % 29 == 0 else c, "yes" if odds > 0 else "no"))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y string")


def brute(bins, y, features, p, n_trees):
    """One leaf at a time, every split of every leaf tried on the rows themselves."""
    scale = float(1 << min(40, 61 - len(y).bit_length()))
    raw = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    trees = []
    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-raw))
        g, h = (np.rint(v * scale).astype(np.int64) for v in (prob - y, prob * (1 - prob)))
        leaves, splits, depth = {0: np.arange(len(y))}, {}, {0: 0}
        fresh = 1

        def best(rows):
            found = (-math.inf,)
            part = lambda r: (g[r].sum() / scale) ** 2 / (h[r].sum() / scale + p.l2)  # noqa: B023, E731
            for f, feature in enumerate(features):
                for b in range(feature.bins):
                    x = bins[rows, f]
                    go = x <= b if feature.bounds is not None else x == b
                    left, right = rows[go], rows[~go]
                    if min(len(left), len(right)) < p.min_child_samples or min(h[left].sum(), h[right].sum()) / scale < p.min_child_weight:  # noqa: B023
                        continue
                    gain = part(left) + part(right) - part(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, f, b, left, right)
            return found

        known = {0: best(leaves[0])}
        while len(leaves) < p.num_leaves:
            able = [i for i in leaves if depth[i] < p.max_depth and known[i][0] > 0]
            if not able:
                break
            i = max(able, key=lambda j: (known[j][0], -j))
            _, f, b, left, right = known[i]
            del leaves[i]
            splits[i] = (f, b, fresh, fresh + 1)
            for child, rows in ((fresh, left), (fresh + 1, right)):
                leaves[child], depth[child], known[child] = rows, depth[i] + 1, best(rows)
            fresh += 2
        trees.append({(f, b) for f, b, *_ in splits.values()})
        for rows in leaves.values():
            raw[rows] += -p.learning_rate * (g[rows].sum() / scale) / (h[rows].sum() / scale + p.l2)
    return trees, raw


def test_trees_equal_brute_force(spark):
    df, p = table(spark), B.LeafwiseParams(**PARAMS)
    model = B.fit(df.repartition(5), "y", ["a", "b"], ["c"], p)
    again = B.fit(df.repartition(2, "c"), "y", ["a", "b"], ["c"], p)
    assert model.trees == again.trees and len(model.trees) == p.rounds
    rows = df.orderBy("id").toPandas()
    import pyarrow as pa

    bins = np.stack([f.codes(pa.array(rows[f.name], from_pandas=f.bounds is None)) for f in model.features], 1)
    y = (rows["y"] == "yes").to_numpy().astype(float)
    trees, raw = brute(bins, y, model.features, p, p.rounds)
    for got, want in zip(model.trees, trees):
        assert {(n.feature, n.bin) for n in got if n.feature >= 0} == want
        assert sum(n.feature < 0 for n in got) <= p.num_leaves and sum(n.rows for n in got if n.feature < 0) == 900
    assert np.allclose(model.raw(bins), raw)


def test_expression_batches_and_reload_agree(spark, tmp_dir):
    df = table(spark)
    model = B.fit(df, "y", ["a", "b"], ["c"], B.LeafwiseParams(**{**PARAMS, "rounds": 12}))
    more = df.unionByName(spark.createDataFrame([(-1, None, None, "new", None), (-2, float("inf"), -5.0, "", "no")], df.schema))
    model.save(spark, tmp_dir + "/m")
    loaded = B.load(spark, tmp_dir + "/m")
    assert loaded == model
    both = model.score(more, "e").join(loaded.score_batches(more, "f").select("id", "f"), "id")
    assert both.where("abs(e - f) > 1e-12 or e is null or f is null").count() == 0 and both.count() == 902
    plan = model.score(more)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
    right = model.predict(df).where(F.col("y") == F.col("predicted_class")).count() / 900
    assert right > 0.8
    nodes = spark.read.parquet(tmp_dir + "/m/nodes")
    assert nodes.count() == sum(map(len, model.trees)) and nodes.where("feature = 'c' and category is null and bound is not null").count() == 0


def test_validation_ends_the_boosting(spark):
    df = table(spark, 600).withColumn("y", F.when(F.xxhash64("id") % 2 == 0, "yes").otherwise("no"))  # nothing to learn
    p = B.LeafwiseParams(**{**PARAMS, "rounds": 40, "validation_share": 0.3, "patience": 2})
    assert len(B.fit(df, "y", ["a", "b"], ["c"], p).trees) < 10


def test_bad_tables(spark):
    df = table(spark, 60)
    for bad in (df.where("y = 'yes'"), df.limit(0), df.withColumn("y", F.col("id").cast("string"))):
        with pytest.raises(ValueError):
            B.fit(bad, "y", ["a"], ["c"], B.LeafwiseParams(**PARAMS))
    # nothing to split on
    model = B.fit(df, "y", ["a"], [], B.LeafwiseParams(**{**PARAMS, "min_child_samples": 50}))
    assert model.trees == [] and model.score(df).select("score").distinct().count() == 1
