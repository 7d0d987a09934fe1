"""Scan a run-store folder tree into run-log tables.

Layout under the root: ``<exp>/meta.yaml``, ``<exp>/<run>/meta.yaml``,
``<exp>/<run>/metrics/<key>`` (lines ``<ts ms> <value> <step>``), ``<exp>/<run>/params/<key>``
and ``<exp>/<run>/tags/<key>`` (the bare value), ``<exp>/<run>/inputs/<id>/meta.yaml``,
``<exp>/datasets/<id>/meta.yaml``. A key may hold slashes: it is the rest of the path.
Registry: ``<name>/meta.yaml``, ``<name>/version-<n>/meta.yaml``, ``<name>/aliases/<alias>``
(the version number); it may lie beside the experiments, in ``models``. Anything elsewhere,
such as a run's artifacts, is not read as run data. Every file is read by Spark (recursive
file lookup); paths come from ``_metadata``, relative to the root and URL-decoded.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators.runlog import CONTEXT_TAG

# Folders that hold no runs, and numeric run status codes of the run store.
MODELS, DATASETS = "models", "datasets"
RUN_STATUS = {"1": "RUNNING", "2": "SCHEDULED", "3": "FINISHED", "4": "FAILED", "5": "KILLED"}


@dataclass
class RunTables:
    experiments: DataFrame
    runs: DataFrame
    metrics: DataFrame
    params: DataFrame
    tags: DataFrame
    inputs: DataFrame
    datasets: DataFrame


def _files(spark: SparkSession, root: str, whole: bool) -> DataFrame:
    """(value, p): lines or whole texts of all files, and the parts of their paths under the root."""
    df = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=whole)
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root)
    if not base.startswith("/"):
        base = os.path.abspath(base)
    base = base.rstrip("/") + "/"
    # a plus sign is no blank in a path
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rest = path.substr(F.locate(base, path) + F.lit(len(base)), F.length(path))
    return df.select(F.col("value"), F.split(rest, "/").alias("p"))


def _part(i: int) -> Column:
    """Path component under the root (1 = the first)."""
    return F.get(F.col("p"), F.lit(i - 1))


def _key() -> Column:
    """The path behind ``<exp>/<run>/<kind>/``."""
    return F.array_join(F.slice("p", F.lit(4), F.greatest(F.size("p") - 3, F.lit(1))), "/")


def _of_run(kind: str) -> Column:
    """Files under ``<exp>/<run>/<kind>/``."""
    return (F.size("p") >= 4) & (_part(3) == kind) & (_part(1) != MODELS) & (_part(2) != DATASETS)


def _yaml(key: str) -> Column:
    """Value of a flat ``key: value`` line of an unfolded YAML text, quotes removed."""
    raw = F.regexp_extract(F.col("doc"), rf"(?m)^{key}: (.*)$", 1)
    unq = F.regexp_replace(raw, r"^'(.*)'$", "$1")
    return F.when(raw == "", F.lit(None).cast("string")).when(unq == "null", F.lit(None)).otherwise(unq)


def scan_run_tree(spark: SparkSession, root: str) -> RunTables:
    lines = _files(spark, root, whole=False)
    whole = _files(spark, root, whole=True).withColumn(
        "doc", F.regexp_replace(F.col("value"), r"\n[ ]{2}(?=[^ -])", " ")
    )
    metric_fields = F.split(F.trim(F.col("value")), " ")
    metrics = lines.where(_of_run("metrics") & (F.trim(F.col("value")) != "")).select(
        _part(2).alias("run_id"),
        _key().alias("key"),
        F.get(metric_fields, F.lit(0)).try_cast("long").alias("ts"),
        F.get(metric_fields, F.lit(1)).try_cast("double").alias("value"),
        F.coalesce(F.get(metric_fields, F.lit(2)).try_cast("long"), F.lit(0)).alias("step"),
    )
    kv = lambda kind: whole.where(_of_run(kind)).select(
        _part(2).alias("run_id"), _key().alias("key"), F.col("value").alias("value")
    )
    depth, is_meta = F.size("p"), F.element_at("p", -1) == "meta.yaml"
    meta = whole.where(is_meta & (_part(1) != MODELS))
    is_run = meta.where((depth == 3) & (_part(2) != DATASETS) & F.col("doc").rlike(r"(?m)^run_id: "))
    status = _yaml("status")
    status_map = F.create_map(*[F.lit(x) for kv_ in RUN_STATUS.items() for x in kv_])
    runs = is_run.select(
        _yaml("run_id").alias("run_id"),
        _yaml("experiment_id").alias("experiment_id"),
        _yaml("run_name").alias("run_name"),
        F.coalesce(F.try_element_at(status_map, status), status).alias("status"),
        _yaml("start_time").try_cast("long").alias("start_time"),
        _yaml("end_time").try_cast("long").alias("end_time"),
        _yaml("artifact_uri").alias("artifact_uri"),
        _yaml("lifecycle_stage").alias("lifecycle_stage"),
    )
    experiments = meta.where((depth == 2) & F.col("doc").rlike(r"(?m)^experiment_id: ")).select(
        _yaml("experiment_id").alias("experiment_id"),
        _yaml("name").alias("name"),
        _yaml("creation_time").try_cast("long").alias("creation_time"),
        _yaml("lifecycle_stage").alias("lifecycle_stage"),
    )
    inputs = meta.where((depth == 5) & (_part(3) == "inputs")).select(
        _part(2).alias("run_id"),
        _yaml("source_id").alias("dataset_id"),
        F.regexp_extract(F.col("value"), re.escape(CONTEXT_TAG) + r": (\S+)", 1).alias("context"),
    )
    profile = F.regexp_replace(_yaml("profile"), "''", "'")
    datasets = meta.where((depth == 4) & (_part(2) == DATASETS)).select(
        _part(3).alias("dataset_id"),
        _yaml("digest").alias("digest"),
        _yaml("name").alias("name"),
        _yaml("source_type").alias("source_type"),
        _yaml("source").alias("source"),
        F.regexp_replace(_yaml("schema"), "''", "'").alias("schema"),
        F.get_json_object(profile, "$.num_rows").cast("long").alias("num_rows"),
        F.get_json_object(profile, "$.num_elements").cast("long").alias("num_elements"),
    )
    return RunTables(experiments, runs, metrics, kv("params"), kv("tags"), inputs, datasets)


def scan_registry(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(model_versions, model_aliases) from a registry folder tree."""
    whole = _files(spark, root, whole=True).withColumn("doc", F.col("value"))
    meta = whole.where(F.element_at("p", -1) == "meta.yaml")
    versions = meta.where((F.size("p") == 3) & _part(2).startswith("version-")).select(
        _yaml("name").alias("name"),
        _yaml("version").try_cast("long").alias("version"),
        _yaml("run_id").alias("run_id"),
        _yaml("source").alias("source"),
        _yaml("creation_timestamp").try_cast("long").alias("created"),
        _yaml("status").alias("status"),
    )
    aliases = whole.where((F.size("p") == 3) & (_part(2) == "aliases")).select(
        _part(1).alias("name_dir"), _part(3).alias("alias"), F.trim("value").try_cast("long").alias("version")
    )
    names = meta.where(F.size("p") == 2).select(_part(1).alias("name_dir"), _yaml("name").alias("name"))
    aliases = aliases.join(names, "name_dir").select("name", "alias", "version")
    return versions, aliases
