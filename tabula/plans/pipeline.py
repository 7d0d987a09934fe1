"""The two end-to-end flows of the original scripts, as Spark jobs.

``prepare``: raw extract -> clean + features -> exact split -> two published tables
with a load timestamp and the change-feed property.
``train_register``: tables -> fit -> evaluate on test -> log metrics/params/input ->
save model -> register a version -> point an alias at it.
``score_alias``: resolve alias -> load model -> contract -> batch score -> decode.
"""

from __future__ import annotations

import dataclasses
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators import contract, evaluate, features, split, tables, train
from tabula.operators.decode import PREDICTION_LABELS
from tabula.operators.runlog import RunStore
from tabula.spec import FeatureSpec


def prepare(raw: DataFrame, spec: FeatureSpec, database: str, month_col: str | None = None,
            ratio: float = 0.2, seed: int = 42, stage: bool = True, mode: str = "overwrite") -> tuple[str, str]:
    """Clean + split + publish. With ``stage`` the cleaned frame is written once as a
    columnar staging table, so the split passes (id column only) and the two table
    writes read Parquet instead of re-parsing the raw text each time. ``mode`` ``append`` adds
    the rows whose ids the published tables do not have."""
    spark = raw.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    pre = features.preprocess(raw, spec, month_col=month_col)
    if stage:
        staging = f"{database}.clean_stage"
        tables.overwrite_table(pre, staging)
        pre = spark.table(staging)
    flagged = split.exact_split(pre, spec.id_columns[0], ratio, seed)
    train_name, test_name = f"{database}.train_set", f"{database}.test_set"
    tables.publish_split(flagged, train_name, test_name, mode=mode, keys=list(spec.id_columns))
    tables.enable_change_feed(spark, train_name, test_name)
    tables.record_versions(spark, f"{database}.table_versions", [train_name, test_name])
    return train_name, test_name


def train_register(
    spark: SparkSession,
    store: RunStore,
    spec: FeatureSpec,
    train_name: str,
    test_name: str,
    model_name: str,
    model_root: str,
    params: train.BoostParams = train.BoostParams(),
    positive: str = "Not_Canceled",
    alias: str = "latest-model",
    experiment_id: str = "default",
    tags: dict | None = None,
    partitions: int = 32,
) -> dict:
    """Fit, evaluate and register one model version; everything a run logs, and what the version
    needs at scoring time (its signature and an input example), is written in one batch."""
    tr, te = spark.table(train_name), spark.table(test_name)
    run_id = store.start_run(experiment_id, "train-register", tags=tags)
    t0 = time.time()
    model = train.fit(tr, spec, params, partitions=partitions)
    fit_seconds = time.time() - t0
    scored = train.score(model, te, spec, keep=[spec.target], out="_pred")
    metrics = evaluate.metrics_long(scored, spec.target, "_pred", positive)
    content = [c for c in tr.columns if c != "update_timestamp_utc"]
    prof = contract.profile(tr, "train_set", digest_cols=content).first()
    db = train_name.rsplit(".", 1)[0] if "." in train_name else "default"
    signature = train.input_contract(tr, spec)
    example = tr.select(*[F.col(c) for c in signature.fieldNames()]).toJSON().first()
    path = f"{model_root}/{run_id}/model"
    train.save(model, path)
    with store.batch():
        store.log_metrics(run_id, metrics)
        store.log_params(run_id, dataclasses.asdict(params))
        store.log_input(run_id, prof, prof["digest"], "training", table=train_name)
        if spark.catalog.tableExists(f"{db}.table_versions"):
            store.set_tags(run_id, {"data_version": tables.current_version(spark, f"{db}.table_versions", train_name)})
        version = store.register_model(model_name, run_id, path, tags, signature.json(), example)
        store.set_alias(model_name, alias, version)
        store.end_run(run_id)
    return {"run_id": run_id, "version": version, "model_path": path, "fit_seconds": fit_seconds}


def score_alias(store: RunStore, model_name: str, alias: str, df: DataFrame, spec: FeatureSpec,
                keep: list[str] | None = None, labels: dict | None = None) -> DataFrame:
    """Score ``df`` by the version that an alias points to, under the signature recorded with that
    version: a missing column or one of a type that does not fit raises before any job on ``df``."""
    mv = store.resolve(model_name, alias)
    signature = T.StructType.fromJson(json.loads(mv.signature)) if mv.signature else train.input_contract(df, spec)
    contract.enforce(df, signature)
    model = train.load(mv.source)
    labels = PREDICTION_LABELS if labels is None else labels
    return train.score(model, df, spec, contract=signature, keep=keep, labels=labels)
