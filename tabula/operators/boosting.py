"""Leaf-wise boosted trees for a binary label, grown from histograms that Spark adds up.

Features are cut into at most 255 bins once: numbers at approximate quantiles, text into a code per category;
bin 0 stands for missing and unseen values. The binned rows, one byte per feature, are written to the shared
folder and are all that later passes read.

A tree grows best split first, up to ``num_leaves``. One job adds up, per (node, feature, bin), the rows and
their first and second derivatives of the log loss; tasks send one row per bin that they met, so what is
shuffled and collected depends on the bins and not on the rows. A job covers the left children of
all leaves that may still be split; right children are the difference to their parent. So a tree
takes about as many jobs as it is deep, and the result is that of splitting one leaf at a time.
Derivatives are added as whole numbers of a fixed scale, which makes sums exact and the model
independent of how rows are partitioned.

Scores of the rows so far are kept in the table and renewed every ``CHECKPOINT`` trees; a lost
executor costs its tasks only. The model is a table of nodes: ``expression`` turns it into one Column
of built-in conditions, ``score`` picks that for small models and a pass over Arrow batches for large ones.
Missing numbers go left in every split, unseen categories are no category.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators.clean import require_columns
from tabula.session import ensure_checkpoint_dir

BINS = 256
CHECKPOINT = 10
#: Nodes of a model up to which it is scored by one Column expression.
EXPRESSION_NODES = 2_000
#: Bits of the whole numbers that derivatives are added as, with those that the number of rows needs.
_BITS = 61


@dataclass(frozen=True)
class LeafwiseParams:
    """Defaults are the original model's: learning rate 0.1, 1000 rounds, 31 leaves, depth 8, 20 rows per
    leaf, 0.8 of the features per tree, seed 42."""

    learning_rate: float = 0.1
    rounds: int = 1000
    num_leaves: int = 31
    max_depth: int = 8
    min_child_samples: int = 20
    min_child_weight: float = 1e-3
    l2: float = 0.0
    feature_share: float = 0.8
    max_bins: int = 255
    seed: int = 42
    #: Share of the rows (by a hash of their content) kept apart; boosting ends ``patience`` rounds after their
    #: loss was lowest, and the trees after that are dropped. 0: all rounds are run.
    validation_share: float = 0.0
    patience: int = 5


@dataclass
class Feature:
    """A number with the upper bounds of its bins, or text with its categories."""

    name: str
    bounds: list[float] | None = None
    categories: list[str] | None = None

    @property
    def bins(self) -> int:
        return (len(self.bounds) + 2) if self.bounds is not None else len(self.categories) + 1

    def codes(self, column: pa.Array) -> np.ndarray:
        if self.bounds is not None:
            values = column.to_numpy(zero_copy_only=False).astype(float)
            return np.where(np.isnan(values), 0, 1 + np.searchsorted(self.bounds, values)).astype(np.uint8)
        place = {c: i + 1 for i, c in enumerate(self.categories)}
        return np.array([place.get(v, 0) for v in column.to_pylist()], np.uint8)


@dataclass
class Node:
    """A leaf (``feature`` -1) or a split: rows in bins up to ``bin`` (numbers) or of it (text) go left."""

    value: float = 0.0
    feature: int = -1
    bin: int = 0
    left: int = -1
    right: int = -1
    gain: float = 0.0
    rows: int = 0


@dataclass
class Ensemble:
    features: list[Feature]
    labels: list[str]
    start: float
    trees: list[list[Node]] = field(default_factory=list)

    # ---------------------------------------------------------------- scoring

    def _left(self, node: Node) -> Column:
        """Whether a row goes left, never null."""
        f = self.features[node.feature]
        if f.bounds is None:
            if node.bin == 0:
                return ~F.coalesce(F.col(f"`{f.name}`").cast("string").isin(f.categories), F.lit(False))
            return F.col(f"`{f.name}`").cast("string").eqNullSafe(F.lit(f.categories[node.bin - 1]))
        v = F.col(f"`{f.name}`").cast("double")
        missing = v.isNull() | F.isnan(v)
        return missing if node.bin == 0 else missing | (v <= F.lit(f.bounds[node.bin - 1]))

    def expression(self) -> Column:
        """The raw score (log-odds) as nested conditions of built-in functions."""

        def branch(tree: list[Node], i: int) -> Column:
            node = tree[i]
            if node.feature < 0:
                return F.lit(node.value)
            return F.when(self._left(node), branch(tree, node.left)).otherwise(branch(tree, node.right))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + branch(tree, 0)
        return total

    def raw(self, bins: np.ndarray, trees: list[list[Node]] | None = None) -> np.ndarray:
        """Scores of binned rows: those of ``trees`` alone, or of the whole model."""
        out = np.full(len(bins), self.start if trees is None else 0.0)
        for tree in self.trees if trees is None else trees:
            at = _settle(bins, tree, self.features)
            out += np.array([n.value for n in tree])[at]
        return out

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` plus the raw score of every row."""
        require_columns(df, [f.name for f in self.features])
        if sum(map(len, self.trees)) <= EXPRESSION_NODES:
            return df.withColumn(out, self.expression())
        return self.score_batches(df, out)

    def score_batches(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``score`` by Arrow batches, for models of any size."""
        from pyspark.sql.types import DoubleType, StructType

        names = [c for c in df.columns if c != out]
        schema = StructType([df.schema[c] for c in names]).add(out, DoubleType())
        wide = df.select(*[F.col(f"`{c}`") for c in names], *_inputs(self.features))

        def run(batches):
            for batch in batches:
                made = pa.array(self.raw(_coded(batch, self.features)), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], made], [*names, out])

        return wide.mapInArrow(run, schema)

    def predict(self, df: DataFrame, out: str = "predicted_class") -> DataFrame:
        """``df`` plus the class of every row: the second label from a score of zero on."""
        raw = f"_{uuid.uuid4().hex}"
        label = F.when(F.col(raw) >= 0, F.lit(self.labels[1])).otherwise(F.lit(self.labels[0]))
        return self.score(df, raw).withColumn(out, label).drop(raw)

    # ---------------------------------------------------------------- as a table

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node, with the split in words of the input."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, n in enumerate(tree):
                f = self.features[n.feature] if n.feature >= 0 else None
                bound = float(f.bounds[n.bin - 1]) if f and f.bounds is not None and n.bin else None
                category = f.categories[n.bin - 1] if f and f.bounds is None and n.bin else None
                rows.append((t, i, f.name if f else None, bound, category, n.left, n.right, float(n.value), float(n.gain), int(n.rows)))
        return spark.createDataFrame(
            rows, "tree int, node int, feature string, bound double, category string, left int, right int, value double, gain double, n_rows long"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model to a folder: its nodes as a table, and what scoring needs as one document."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode("overwrite").text(f"{path}/model")


def load(spark: SparkSession, path: str) -> Ensemble:
    d = json.loads(spark.read.text(f"{path}/model").first()[0])
    return Ensemble([Feature(**f) for f in d["features"]], d["labels"], d["start"], [[Node(**n) for n in t] for t in d["trees"]])


# -------------------------------------------------------------------- rows


def _inputs(features: list[Feature]) -> list[Column]:
    """The feature columns under names of their own, as doubles and text."""
    return [
        F.col(f"`{f.name}`").cast("double" if f.bounds is not None else "string").alias(f"_feature_{i}") for i, f in enumerate(features)
    ]


def _coded(batch: pa.RecordBatch, features: list[Feature]) -> np.ndarray:
    columns = [f.codes(batch.column(f"_feature_{i}")) for i, f in enumerate(features)]
    return np.stack(columns, 1) if columns else np.zeros((batch.num_rows, 0), np.uint8)


def _settle(bins: np.ndarray, tree: list[Node], features: list[Feature]) -> np.ndarray:
    """The node of ``tree`` that each row ends in. Children come after their parent."""
    at = np.zeros(len(bins), np.int64)
    for i, node in enumerate(tree):
        if node.feature >= 0:
            own = np.flatnonzero(at == i)
            x = bins[own, node.feature]
            left = x <= node.bin if features[node.feature].bounds is not None else x == node.bin
            at[own] = np.where(left, node.left, node.right)
    return at


def fit_features(df: DataFrame, num_cols, cat_cols, max_bins: int = 255) -> list[Feature]:
    """Bins of every feature: one aggregation for the numbers, one for the categories; of a column with more
    categories the most frequent ones."""
    out, num_cols, cat_cols = [], list(num_cols), list(cat_cols)
    if num_cols:
        shares = [(i + 1) / (max_bins - 1) for i in range(max_bins - 2)]
        value = lambda c: F.col(f"`{c}`").cast("double")
        row = df.agg(*[F.percentile_approx(F.when(~F.isnan(value(c)), value(c)), shares, 10_000).alias(f"_{i}") for i, c in enumerate(num_cols)]).first()
        out += [Feature(c, bounds=sorted({float(x) for x in row[i] or []})) for i, c in enumerate(num_cols)]
    if cat_cols:
        pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in cat_cols])).alias("p")
        counted = df.select(pair).select("p.c", "p.v").where("v is not null").groupBy("c", "v").count()
        for c in cat_cols:
            top = counted.where(F.col("c") == F.lit(c)).orderBy(F.desc("count"), "v").limit(max_bins - 1).collect()
            out.append(Feature(c, categories=sorted(r.v for r in top)))
    return out


def binned(df: DataFrame, label_col: str, features: list[Feature], labels: list[str], params: LeafwiseParams) -> DataFrame:
    """(bins, y, apart): a byte per feature, the label, and whether the row is kept for validation."""
    names = [f.name for f in features]
    share = F.pmod(F.xxhash64(F.lit(params.seed), *[F.col(f"`{c}`") for c in (*names, label_col)]), F.lit(10_000))
    rows = df.select(
        *_inputs(features), (F.col(f"`{label_col}`").cast("string") == F.lit(labels[1])).cast("double").alias("y"),
        (share < int(params.validation_share * 10_000)).alias("apart"),
    ).where("y is not null")

    def run(batches):
        for batch in batches:
            made = [row.tobytes() for row in _coded(batch, features)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), batch.column("y"), batch.column("apart")], ["bins", "y", "apart"])

    return rows.mapInArrow(run, "bins binary, y double, apart boolean")


# -------------------------------------------------------------------- growing


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, width)


def _derivatives(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-raw))
    return p - y, p * (1 - p)


def _added(table: DataFrame, model: Ensemble, trees: list[list[Node]], tree: list[Node], asked: list[int], scale: float) -> dict[int, np.ndarray]:
    """{node: (3, features, bins) sums of rows, first and second derivatives} of the nodes ``asked`` of the
    ``tree`` so far; ``trees`` are those that the table's scores lack. Node -1 holds the validation loss."""
    features, width = model.features, len(model.features)
    size = width * BINS

    def run(batches):
        sums = np.zeros((len(asked), 3, size), np.int64)
        place = np.full(max(len(tree), 1), -1)
        place[asked] = np.arange(len(asked))
        loss = np.zeros(2)
        for batch in batches:
            bins, y = _matrix(batch, width), batch.column("y").to_numpy()
            raw = batch.column("raw").to_numpy() + model.raw(bins, trees)
            apart = batch.column("apart").to_numpy(zero_copy_only=False).astype(bool)
            loss += [np.logaddexp(0, np.where(y > 0, -raw, raw))[apart].sum(), apart.sum()]
            own = place[_settle(bins, tree, features)]
            keep = np.flatnonzero((own >= 0) & ~apart)
            if not len(keep):
                continue
            g, h = _derivatives(raw[keep], y[keep])
            weights = (None, np.rint(g * scale), np.rint(h * scale))
            at = own[keep, None] * size + np.arange(width) * BINS + bins[keep]
            for k, w in enumerate(weights):
                # sums of whole numbers under 2**53 are exact in doubles, as a batch has a few thousand rows
                flat = np.bincount(at.ravel(), None if w is None else np.repeat(w, width), len(asked) * size)
                sums[:, k] += np.rint(flat).astype(np.int64).reshape(len(asked), size)
        node, place_ = np.nonzero(sums[:, 0])
        columns = [np.array(asked, np.int32)[node], place_.astype(np.int32), *(sums[node, k, place_] for k in range(3))]
        columns = [np.append(c, [v]) for c, v in zip(columns, (-1, 0, int(loss[1]), round(loss[0] * (1 << 20)), 0), strict=True)]
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["node", "at", "n", "g", "h"])

    parts = table.mapInArrow(run, "node int, at int, n long, g long, h long")
    total = parts.groupBy("node", "at").agg(*[F.sum(c).alias(c) for c in ("n", "g", "h")])
    out = {node: np.zeros((3, size), np.int64) for node in asked}
    for r in total.collect():  # at most a row per node, feature and bin
        if r.node < 0:
            out[-1] = np.array([r.n, r.g, r.h])
        else:
            out[r.node][:, r.at] = r.n, r.g, r.h
    return {k: v.reshape(3, width, BINS) if k >= 0 else v for k, v in out.items()}


def split_gains(sums: np.ndarray, features: list[Feature], params: LeafwiseParams, scale: float) -> np.ndarray:
    """(features, bins): the gain of every split of a node, -inf where a side would be too small."""
    n, g, h = (s.astype(float) for s in sums)
    g, h = g / scale, h / scale
    whole = [x.sum(1, keepdims=True) for x in (n, g, h)]
    numeric = np.array([f.bounds is not None for f in features])[:, None]
    left = [np.where(numeric, x.cumsum(1), x) for x in (n, g, h)]
    right = [w - x for w, x in zip(whole, left, strict=True)]
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda s: s[1] ** 2 / (s[2] + params.l2)
        gain = part(left) + part(right) - part(whole)
    able = [(s[0] >= max(1, params.min_child_samples)) & (s[2] >= params.min_child_weight) for s in (left, right)]
    return np.where(able[0] & able[1] & np.isfinite(gain), gain, -np.inf)


def root_splits(df: DataFrame, label_col: str, features: list[Feature], params: LeafwiseParams = LeafwiseParams()) -> DataFrame:
    """(feature, bound, category, n_left, n_right, gain) of every split that the first tree may begin with."""
    spark = df.sparkSession
    labels = sorted(r[0] for r in df.select(F.col(f"`{label_col}`").cast("string")).where(f"`{label_col}` is not null").distinct().limit(3).collect())
    rows = binned(df, label_col, features, labels, params)
    n, good = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    scale = float(1 << min(40, _BITS - int(n).bit_length()))
    model = Ensemble(features, labels, math.log(good / (n - good)))
    sums = _added(rows.withColumn("raw", F.lit(model.start)), model, [], [Node()], [0], scale)[0]
    gains, out = split_gains(sums, features, params, scale), []
    for f, b in zip(*np.nonzero(np.isfinite(gains)), strict=True):
        own, here = features[f], sums[0][f]
        left = int(here[: b + 1].sum() if own.bounds is not None else here[b])
        bound = float(own.bounds[b - 1]) if own.bounds is not None and 0 < b <= len(own.bounds) else None
        category = own.categories[b - 1] if own.bounds is None and b else None
        out.append((own.name, bound, category, left, int(here.sum()) - left, float(gains[f, b])))
    return spark.createDataFrame(out, "feature string, bound double, category string, n_left long, n_right long, gain double")


def _best(sums: np.ndarray, features, chosen: np.ndarray, params: LeafwiseParams, scale: float) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split, ties to the first feature and bin."""
    gains = np.where(chosen[:, None], split_gains(sums, features, params, scale), -np.inf)
    at = int(np.argmax(gains))
    return float(gains.flat[at]), at // BINS, at % BINS


def _grow(table, model: Ensemble, trees, params: LeafwiseParams, scale: float, chosen: np.ndarray):
    """(tree, sums of node -1): one tree, best split first."""
    tree, depth, parent = [Node()], {0: 0}, {}
    first = _added(table, model, trees, tree, [0], scale)
    sums, best = {0: first[0]}, {}

    def split_off(i: int, feature: int, bin_: int) -> None:
        node = tree[i]
        node.feature, node.bin, node.left, node.right = feature, bin_, len(tree), len(tree) + 1
        for child in (node.left, node.right):
            tree.append(Node())
            depth[child], parent[child] = depth[i] + 1, i

    def find(i: int) -> None:
        best[i] = _best(sums[i], model.features, chosen, params, scale) if depth[i] < params.max_depth else (-math.inf, 0, 0)

    find(0)
    while True:
        # the best splits one after another, as far as the sums of the children are known
        leaves, taken, waiting = {0}, set(), None
        while len(leaves) < params.num_leaves:
            top = max(leaves, key=lambda i: (best[i][0], -i))
            if best[top][0] <= 0:
                break
            if tree[top].feature < 0:
                waiting = top
                break
            leaves.remove(top)
            taken.add(top)
            leaves |= {tree[top].left, tree[top].right}
        if waiting is None:
            break
        room = params.num_leaves - len(leaves)
        open_ = sorted((i for i in leaves if tree[i].feature < 0 and best[i][0] > 0), key=lambda i: (-best[i][0], i))[:room]
        for i in open_:
            split_off(i, *best[i][1:])
        asked = [tree[i].left for i in open_]
        found = _added(table, model, trees, tree, asked, scale)
        for i in open_:
            node = tree[i]
            sums[node.left], sums[node.right] = found[node.left], sums[i] - found[node.left]
            find(node.left)
            find(node.right)
    # the nodes that were taken, numbered anew with children after their parent
    order, names = [0], {0: 0}
    for i in order:
        if i in taken:
            for child in (tree[i].left, tree[i].right):
                names[child] = len(order)
                order.append(child)
    out = []
    for i in order:
        n, g, h = (int(s.sum()) for s in sums[i][:, 0]) if len(model.features) else (0, 0, 0)
        weight = h / scale + params.l2
        node = Node(rows=n, value=-params.learning_rate * (g / scale) / weight if weight > 0 else 0.0)
        if i in taken:
            node = Node(0.0, tree[i].feature, tree[i].bin, names[tree[i].left], names[tree[i].right], best[i][0], n)
        out.append(node)
    return out, first.get(-1)


def fit(df: DataFrame, label_col: str, num_cols=(), cat_cols=(), params: LeafwiseParams = LeafwiseParams(),
        features: list[Feature] | None = None) -> Ensemble:
    """A model of the rows of ``df`` with a label; there must be two labels, ordered as text. ``features`` gives
    bins of one's own instead of fitted ones."""
    require_columns(df, [label_col, *num_cols, *cat_cols])
    spark, path = df.sparkSession, f"{ensure_checkpoint_dir(df.sparkSession)}/boosting-{uuid.uuid4().hex}"
    labels = sorted(r[0] for r in df.select(F.col(f"`{label_col}`").cast("string")).where(f"`{label_col}` is not null").distinct().limit(3).collect())
    if len(labels) != 2:
        raise ValueError(f"{label_col} must have two values, not {labels}")
    features = features or fit_features(df, num_cols, cat_cols, params.max_bins)
    binned(df, label_col, features, labels, params).write.parquet(f"{path}/rows")
    table = spark.read.parquet(f"{path}/rows")
    n, good = table.where("not apart").agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not 0 < good < n:
        raise ValueError("training rows must have both labels")
    scale = float(1 << min(40, _BITS - int(n).bit_length()))
    model = Ensemble(features, labels, math.log(good / (n - good)))
    table, late, losses = table.withColumn("raw", F.lit(model.start)), [], []
    width, whole = len(features), len(features)
    for t in range(params.rounds + 1):
        rng = np.random.default_rng([params.seed, t])
        chosen = np.zeros(whole, bool)
        chosen[rng.choice(whole, max(1, round(params.feature_share * whole)), replace=False)] = True
        tree, loss = _grow(table, model, late, params, scale, chosen)
        if loss is not None and loss[0]:
            losses.append(loss[1])  # of the trees before this one
            lowest = int(np.argmin(losses))
            if t - lowest >= params.patience or t == params.rounds:
                model.trees = model.trees[:lowest]
                break
        if t == params.rounds or len(tree) == 1:
            break
        model.trees.append(tree)
        late.append(tree)
        if len(late) == CHECKPOINT:
            table, late = _rescored(table, model, late, width, f"{path}/scores-{t}"), []
    return model


def _rescored(table: DataFrame, model: Ensemble, late, width: int, path: str) -> DataFrame:
    """The table with the scores of ``late`` added, written anew."""

    def run(batches):
        for batch in batches:
            raw = batch.column("raw").to_numpy() + model.raw(_matrix(batch, width), late)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("bins", "y", "apart")), pa.array(raw)], ["bins", "y", "apart", "raw"])

    table.select("bins", "y", "apart", "raw").mapInArrow(run, "bins binary, y double, apart boolean, raw double").write.parquet(path)
    return table.sparkSession.read.parquet(path)
