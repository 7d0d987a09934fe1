"""Fit, save, load and batch-score the boosted-tree pipeline with Spark ML.

Stages: categorical text (missing -> its own sentinel category) -> StringIndexer
(alphabetical, unseen -> an extra index) -> OneHotEncoder(dropLast) so an unseen
value encodes as an all-zero block -> mean Imputer + was-missing flags for the
numeric columns (the tree learner rejects NaN) -> VectorAssembler (one-hot blocks
in categorical order, then numerics) -> GBTClassifier. The label is indexed
alphabetically, and predictions are turned back into class names and then into
display labels. Everything runs as distributed Spark ML jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.clean import require_columns
from tabula.operators.contract import enforce
from tabula.operators.decode import decode_expr
from tabula.operators.features import NULL_CATEGORY
from tabula.session import ensure_checkpoint_dir
from tabula.spec import FeatureSpec

LABEL, FEATURES, PREDICTION, PREDICTED = "_label", "features", "prediction", "predicted_class"
VALIDATION = "_validation"
#: Training rows of a partition, and partitions at least.
FIT_ROWS, FIT_PARTITIONS = 250_000, 8


@dataclass(frozen=True)
class BoostParams:
    """Boosted-tree settings. Defaults are the original model's
    (learning rate 0.1, 1000 rounds, depth 8, 20 rows per leaf, 0.8 feature and row share, seed 42)."""

    step_size: float = 0.1
    max_iter: int = 1000
    max_depth: int = 8
    min_instances_per_node: int = 20
    feature_subset: str = "0.8"
    subsampling_rate: float = 0.8
    seed: int = 42
    max_bins: int = 32
    #: Share of the training rows kept apart to end the boosting when their loss stops falling
    #: (0: all rounds are run, as in the original model).
    validation_share: float = 0.0
    validation_tol: float = 0.01


def _cat_text(c: str) -> str:
    return f"{c}__text"


def build_features(spec: FeatureSpec, missing_flags: bool = True) -> Pipeline:
    """The stages up to the feature vector: label index, then one-hot blocks, numbers, flags."""
    cats, nums = list(spec.cat_features), list(spec.num_features)
    text_cols = ", ".join(
        f"coalesce(CAST(`{c}` AS STRING), '{NULL_CATEGORY}') AS `{_cat_text(c)}`" for c in cats
    )
    flag_cols = ", ".join(f"CAST(isnull(`{c}`) OR isnan(`{c}`) AS DOUBLE) AS `{c}__missing`" for c in nums)
    num_cast = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}__num`" for c in nums)
    extra = ", ".join(x for x in (text_cols, flag_cols if missing_flags else "", num_cast) if x)
    prep = SQLTransformer(statement=f"SELECT *, {extra} FROM __THIS__")
    label = StringIndexer(inputCol=spec.target, outputCol=LABEL, stringOrderType="alphabetAsc", handleInvalid="error")
    index = StringIndexer(
        inputCols=[_cat_text(c) for c in cats],
        outputCols=[f"{c}__idx" for c in cats],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    onehot = OneHotEncoder(
        inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__oh" for c in cats], dropLast=True, handleInvalid="error"
    )
    impute = Imputer(strategy="mean", inputCols=[f"{c}__num" for c in nums], outputCols=[f"{c}__imp" for c in nums])
    inputs = [f"{c}__oh" for c in cats] + [f"{c}__imp" for c in nums]
    if missing_flags:
        inputs += [f"{c}__missing" for c in nums]
    assemble = VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error")
    return Pipeline(stages=[prep, label, index, onehot, impute, assemble])


def build_pipeline(spec: FeatureSpec, params: BoostParams = BoostParams(), missing_flags: bool = True) -> Pipeline:
    early = {"validationIndicatorCol": VALIDATION, "validationTol": params.validation_tol} if params.validation_share else {}
    gbt = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        predictionCol=PREDICTION,
        stepSize=params.step_size,
        maxIter=params.max_iter,
        maxDepth=params.max_depth,
        minInstancesPerNode=params.min_instances_per_node,
        featureSubsetStrategy=params.feature_subset,
        subsamplingRate=params.subsampling_rate,
        maxBins=params.max_bins,
        seed=params.seed,
        **early,
    )
    return Pipeline(stages=[*build_features(spec, missing_flags).getStages(), gbt])


def fit(
    train: DataFrame,
    spec: FeatureSpec,
    params: BoostParams = BoostParams(),
    missing_flags: bool = True,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit on the training frame; returns a model whose last stage names the class.

    The boosting samples rows by partition and position, so the rows are dealt to
    ``partitions`` partitions by a hash of their content and sorted there: the model depends on
    the rows and on this setting, not on the layout of the input. By default there is one partition
    for every ``FIT_ROWS`` rows, and ``FIT_PARTITIONS`` at least.
    """
    require_columns(train, [*spec.inputs, spec.target])
    ensure_checkpoint_dir(train.sparkSession)  # the boosting cuts its lineage every ten rounds
    data = train.select(*spec.inputs, spec.target)
    if params.validation_share:
        share = F.pmod(F.xxhash64(F.lit(params.seed), *data.columns), F.lit(10_000)) < int(params.validation_share * 10_000)
        data = data.withColumn(VALIDATION, share)
    partitions = partitions or max(FIT_PARTITIONS, -(-data.count() // FIT_ROWS))
    content = F.xxhash64(*data.columns)
    # Every stage fit and every boosting round reads the input: keep it (spillable,
    # recomputed from lineage if an executor is lost) instead of re-running upstream.
    dealt = data.repartition(partitions, content).sortWithinPartitions(content, *data.columns)
    dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = build_pipeline(spec, params, missing_flags).fit(dealt)
    finally:
        dealt.unpersist()
    labels = model.stages[1].labels
    decode = IndexToString(inputCol=PREDICTION, outputCol=PREDICTED, labels=labels)
    return PipelineModel(stages=[*model.stages, decode])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def input_contract(train: DataFrame, spec: FeatureSpec) -> T.StructType:
    """Scoring signature: the model inputs (numeric then categorical) with their types."""
    by_name = {f.name: f.dataType for f in train.schema.fields}
    return T.StructType([T.StructField(c, by_name[c], True) for c in spec.inputs])


def score(
    model: PipelineModel,
    df: DataFrame,
    spec: FeatureSpec,
    contract: T.StructType | None = None,
    keep: list[str] | None = None,
    labels: dict | None = None,
    out: str = "prediction_label",
) -> DataFrame:
    """Batch scoring: enforce the contract (extra columns allowed), predict, decode.

    ``keep`` columns (for example ids) are carried through; one output row per input row.
    """
    keep = list(keep or [])
    if contract is not None:
        enforce(df, contract)  # missing names or unsafe casts fail here, before any job
        inputs = [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields]
        names = contract.fieldNames()
    else:
        names = list(spec.inputs)
        inputs = [F.col(c) for c in names]
    carried = df.select(*[k for k in keep if k not in names], *inputs)
    scored = model.transform(carried)
    label = decode_expr(PREDICTED, labels) if labels else F.col(PREDICTED)
    return scored.select(*keep, label.alias(out))
