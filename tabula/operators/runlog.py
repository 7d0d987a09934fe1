"""Run-log and model-registry work as table operations.

Tables (long form): ``runs``, ``metrics(run_id, key, ts, value, step)``,
``params(run_id, key, value)``, ``tags(run_id, key, value)``, ``experiments``,
``experiment_tags``, ``inputs``, ``datasets``, ``model_versions``, ``model_aliases``.
Searches are Column predicates and semi joins; "latest" values are ``max_by``
aggregations (partial aggregation, so a run with huge histories stays cheap).
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.sequence import sequence_within

# The alias name the registry reserves, the run-store tag keys for a run's
# parent and for a dataset input's context.
RESERVED_ALIASES = ("latest",)
PARENT_TAG = "mlflow.parentRunId"
CONTEXT_TAG = "mlflow.data.context"

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.LongType()),
        T.StructField("end_time", T.LongType()),
        T.StructField("artifact_uri", T.StringType()),
        T.StructField("lifecycle_stage", T.StringType()),
    ]
)
METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
    ]
)
KEY_VALUE = T.StructType(
    [T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)
MODEL_VERSIONS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("created", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("signature", T.StringType()),
        T.StructField("input_example", T.StringType()),
    ]
)
MODEL_ALIASES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("alias", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("ts", T.LongType()),
    ]
)


# ---------------------------------------------------------------- metrics


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """One value per (run, key): highest step, then newest timestamp, then largest value."""
    order = F.struct("step", "ts", "value")
    best = F.max_by(F.struct("value", "step", "ts"), order)
    return metrics.groupBy("run_id", "key").agg(best.alias("_m")).select(
        "run_id", "key", "_m.value", "_m.step", "_m.ts"
    )


def metric_maps(metrics: DataFrame) -> DataFrame:
    """(run_id, metrics map<key, latest value>), keys sorted."""
    latest = latest_metrics(metrics)
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return latest.groupBy("run_id").agg(F.map_from_entries(entries).alias("metrics"))


def kv_maps(kv: DataFrame, out: str) -> DataFrame:
    """(run_id, map<key, value>) for params or tags."""
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return kv.groupBy("run_id").agg(F.map_from_entries(entries).alias(out))


# ---------------------------------------------------------------- searches


def _tag_filter(tags: DataFrame, key: str, value: str, op: str) -> DataFrame:
    cond = {"=": F.col("value") == F.lit(value), "!=": F.col("value") != F.lit(value)}[op]
    return tags.where((F.col("key") == F.lit(key)) & cond).select("run_id")


def search_runs(
    runs: DataFrame,
    metrics: DataFrame | None = None,
    tags: DataFrame | None = None,
    *,
    params: DataFrame | None = None,
    experiments: DataFrame | None = None,
    experiment_ids=None,
    experiment_names=None,
    status: str | None = None,
    lifecycle_stage: str | None = None,
    started_after_ms: int | None = None,
    name_like: str | None = None,
    name_equals: str | None = None,
    metric_gt: dict | None = None,
    param_eq: dict | None = None,
    tag_eq: dict | None = None,
    tag_ne: dict | None = None,
) -> DataFrame:
    """Runs matching every given condition (a conjunction).

    A tag condition ``!=`` needs the tag to be present (semi join with ``<>``), and a
    metric condition applies to the latest value of that key. The conditions on the runs
    themselves come first; only histories of runs that are left, and only of the keys asked
    for, are reduced, once for all metric conditions.
    """
    out = runs
    if experiment_ids is not None:
        out = out.where(F.col("experiment_id").isin(list(experiment_ids)))
    if experiment_names is not None:
        named = experiments.where(F.col("name").isin(list(experiment_names))).select("experiment_id")
        out = out.join(named, "experiment_id", "left_semi")
    if status is not None:
        out = out.where(F.col("status") == F.lit(status))
    if lifecycle_stage is not None:
        out = out.where(F.col("lifecycle_stage") == F.lit(lifecycle_stage))
    if started_after_ms is not None:
        out = out.where(F.col("start_time") > F.lit(started_after_ms))
    if name_like is not None:
        out = out.where(F.col("run_name").like(name_like))
    if name_equals is not None:
        out = out.where(F.col("run_name") == F.lit(name_equals))
    for rows, conds, op in ((params, param_eq, "="), (tags, tag_eq, "="), (tags, tag_ne, "!=")):
        for key, value in (conds or {}).items():
            out = out.join(_tag_filter(rows, key, value, op), "run_id", "left_semi")
    if metric_gt:
        asked = metrics.where(F.col("key").isin(list(metric_gt))).join(out.select("run_id"), "run_id", "left_semi")
        holds = F.lit(False)
        for key, bound in metric_gt.items():
            holds = holds | ((F.col("key") == F.lit(key)) & (F.col("value") > F.lit(bound)))
        hit = latest_metrics(asked).where(holds).groupBy("run_id").count().where(F.col("count") == len(metric_gt))
        out = out.join(hit.select("run_id"), "run_id", "left_semi")
    return out


def newest(runs: DataFrame, n: int = 1) -> DataFrame:
    """Newest ``n`` runs: start time descending, run id as a tiebreak (top-k, no full sort)."""
    return runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(n)


def experiments_by_tag(experiments: DataFrame, experiment_tags: DataFrame, key: str, value: str) -> DataFrame:
    """Experiments carrying tag ``key = value`` (latest value of the tag)."""
    current = upsert_latest(experiment_tags, ["experiment_id", "key"], "ts", tiebreak=_written(experiment_tags))
    hit = current.where((F.col("key") == F.lit(key)) & (F.col("value") == F.lit(value))).select("experiment_id")
    return experiments.join(hit, "experiment_id", "left_semi")


def versions_of(model_versions: DataFrame, name: str | None = None, run_id: str | None = None,
                tags: dict | None = None) -> DataFrame:
    """Model versions filtered by name, producing run and/or tag values (all optional)."""
    out = model_versions
    if name is not None:
        out = out.where(F.col("name") == F.lit(name))
    if run_id is not None:
        out = out.where(F.col("run_id") == F.lit(run_id))
    for k, v in (tags or {}).items():
        out = out.where(F.try_element_at(F.col("tags"), F.lit(k)) == F.lit(str(v)))
    return out


# ---------------------------------------------------------------- nested runs


def child_metrics_wide(
    runs: DataFrame, tags: DataFrame, metrics: DataFrame, keys: list[str], parent_tag: str = PARENT_TAG
) -> DataFrame:
    """One row per child run: parent id, child id, one column per metric key."""
    parents = tags.where(F.col("key") == F.lit(parent_tag)).select("run_id", F.col("value").alias("parent_run_id"))
    children = runs.select("run_id").join(parents, "run_id")
    latest = latest_metrics(metrics).where(F.col("key").isin(keys))
    wide = latest.groupBy("run_id").pivot("key", keys).agg(F.first("value"))
    return children.join(wide, "run_id", "left").select("parent_run_id", "run_id", *keys)


def best_child(wide: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """Per parent: the child with the best value of ``metric`` (ties to the larger run id)."""
    v = F.col(metric) if maximize else -F.col(metric)
    pick = F.max_by(F.struct(F.col("run_id"), F.col(metric).alias("value")), F.struct(v, F.col("run_id")))
    return (
        wide.where(F.col(metric).isNotNull())
        .groupBy("parent_run_id")
        .agg(pick.alias("_b"))
        .select("parent_run_id", F.col("_b.run_id").alias("best_run_id"), F.col("_b.value").alias("best_value"))
    )


# ---------------------------------------------------------------- writes


def merge_params(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Classify new params against logged ones and each other: ``new``, ``same`` (already logged
    with that value, dropped) or ``conflict`` (logged, or given in the same batch, with another
    value, rejected). Equal rows of the batch are one."""
    old = existing.select("run_id", "key", F.col("value").alias("_old"), F.lit(True).alias("_seen"))
    # dealt by run and key once: the steps that follow, and the join, need no other shuffle of it
    rows = new.select("run_id", "key", "value").repartition("run_id", "key").distinct()
    given = rows.groupBy("run_id", "key").agg(F.count(F.lit(1)).alias("_given"))
    j = rows.join(given, ["run_id", "key"]).join(old, ["run_id", "key"], "left")
    outcome = (
        F.when(F.col("_given") > 1, F.lit("conflict"))
        .when(F.col("_seen").isNull(), F.lit("new"))
        .when(F.col("_old").eqNullSafe(F.col("value")), F.lit("same"))
        .otherwise(F.lit("conflict"))
    )
    return j.select("run_id", "key", "value", F.col("_old").alias("logged_value"), outcome.alias("outcome"))


class ParamConflictError(ValueError):
    """A param was logged again with a different value."""


def params_to_append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append; raises when any param conflicts (one bounded probe job)."""
    merged = merge_params(existing, new)
    bad = merged.where(F.col("outcome") == "conflict").limit(5).collect()
    if bad:
        raise ParamConflictError([(r.run_id, r.key, r.logged_value, r.value) for r in bad])
    return merged.where(F.col("outcome") == "new").select("run_id", "key", "value")


def upsert_latest(rows: DataFrame, keys: list[str], ts_col: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Last write wins per key: the row with the newest ``ts_col`` (then ``tiebreak``)."""
    others = [c for c in rows.columns if c not in keys]
    order = F.struct(F.col(ts_col), *[F.col(c) for c in (tiebreak or [])])
    best = F.max_by(F.struct(*[F.col(c) for c in others]), order)
    return rows.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def alias_allowed(alias: str | Column) -> Column:
    """Whether an alias may be set: the reserved names, in any case, may not."""
    alias = F.col(alias) if isinstance(alias, str) else alias
    return ~F.lower(alias).isin(list(RESERVED_ALIASES))


def check_alias(alias: str) -> str:
    """Reserved alias names are refused on set and on load."""
    if alias.lower() in RESERVED_ALIASES:
        raise ValueError(f"alias '{alias}' is reserved")
    return alias


def _written(rows: DataFrame) -> list[str]:
    """The write order of store rows, where a table has it."""
    return ["seq"] if "seq" in rows.columns else []


def assign_versions(
    registrations: DataFrame,
    existing: DataFrame | None,
    order_cols: list[str | Column],
    name_col: str = "name",
) -> DataFrame:
    """Version numbers for new registrations: continue after the highest existing
    version of each name, in ``order_cols`` order (skew-proof numbering)."""
    numbered = sequence_within(registrations, [name_col], order_cols, out="_seq")
    if existing is None:
        base = F.lit(0).cast("long")
        out = numbered
    else:
        top = existing.groupBy(name_col).agg(F.max("version").alias("_top"))
        out = numbered.join(top, name_col, "left")
        base = F.coalesce(F.col("_top"), F.lit(0)).cast("long")
    return out.withColumn("version", base + F.col("_seq")).drop("_seq", "_top")


def resolve_aliases(aliases: DataFrame, versions: DataFrame, runs: DataFrame | None = None,
                    tiebreak: list[str] | None = None) -> DataFrame:
    """Every alias -> the version it points to now; with ``runs`` also -> the run that made the
    version and its artifact folder. An alias of a version that is not there gives no row."""
    current = upsert_latest(aliases, ["name", "alias"], "ts", tiebreak=tiebreak or _written(aliases))
    out = current.select("name", "alias", "version").join(versions, ["name", "version"])
    if runs is not None:
        out = out.join(runs.select("run_id", "run_name", "artifact_uri"), "run_id", "left")
    return out


def resolve_alias(aliases: DataFrame, versions: DataFrame, name: str, alias: str, runs: DataFrame | None = None) -> DataFrame:
    """One alias of one model, as ``resolve_aliases``."""
    check_alias(alias)
    own = aliases.where((F.col("name") == F.lit(name)) & (F.col("alias") == F.lit(alias)))
    return resolve_aliases(own, versions.where(F.col("name") == F.lit(name)), runs).drop("alias")


def run_inputs(inputs: DataFrame, datasets: DataFrame, run_id: str | None = None) -> DataFrame:
    """Datasets that runs (or one run) consumed, with their context tag."""
    if run_id is not None:
        inputs = inputs.where(F.col("run_id") == F.lit(run_id))
    return inputs.join(datasets, inputs["dataset_digest"] == datasets["digest"], "inner").drop("dataset_digest")


def run_lookup(run_id: str, runs: DataFrame, metrics: DataFrame, params: DataFrame, tags: DataFrame) -> DataFrame:
    """One run as rows (kind, key, value text): its fields, latest metrics, params and tags."""
    mine = F.col("run_id") == F.lit(run_id)
    run = runs.where(mine)
    fields = run.select(*[F.col(c).cast("string") for c in run.columns]).unpivot([], run.columns, "key", "value")
    rows = fields.select(F.lit("info").alias("kind"), "key", "value")
    for kind, part in (("metric", latest_metrics(metrics.where(mine))), ("param", params.where(mine)), ("tag", tags.where(mine))):
        rows = rows.unionByName(part.select(F.lit(kind).alias("kind"), "key", F.col("value").cast("string").alias("value")))
    return rows


# ---------------------------------------------------------------- table-backed store


def relative_bound_ms(seconds_ago: float, now_ms: int | None = None) -> int:
    """Epoch milliseconds of a moment ``seconds_ago`` before now, for run searches."""
    if now_ms is None:
        now_ms = time.time_ns() // 1_000_000
    return now_ms - round(seconds_ago * 1000)


_STORE_TABLES = {
    "runs": "run_id string, experiment_id string, run_name string, status string, start_time bigint, "
    "end_time bigint, artifact_uri string, lifecycle_stage string, updated bigint, seq bigint",
    "metrics": "run_id string, key string, ts bigint, value double, step bigint",
    "params": "run_id string, key string, value string",
    "tags": "run_id string, key string, value string, ts bigint, seq bigint",
    "inputs": "run_id string, dataset_digest string, context string",
    "datasets": "digest string, name string, source_type string, source string, schema string, "
    "num_rows bigint, num_elements bigint",
    "model_versions": "name string, version bigint, run_id string, source string, created bigint, status string, "
    "tags map<string,string>, signature string, input_example string",
    "model_aliases": "name string, alias string, version bigint, ts bigint, seq bigint",
    "experiments": "experiment_id string, name string, creation_time bigint, lifecycle_stage string",
    "experiment_tags": "experiment_id string, key string, value string, ts bigint, seq bigint",
}


class RunStore:
    """Run log and model registry kept as append-only tables in one database.

    Current state (run status, tag values, alias targets) is read back with
    ``upsert_latest`` over the appended rows, so writers never rewrite a table. Rows carry the
    order of their writing (``seq``), which decides between rows of the same millisecond.
    Inside ``with store.batch():`` the rows are held back, and each table is written once, the
    tables side by side, when the block ends without an error.
    """

    def __init__(self, spark, database: str = "runlog", fmt: str = "parquet", artifact_root: str | None = None) -> None:
        self.spark, self.db, self.fmt, self.artifact_root = spark, database, fmt, artifact_root
        self._held: dict[str, list[tuple]] | None = None
        self._last_seq = 0
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, ddl in _STORE_TABLES.items():
            if not spark.catalog.tableExists(self._name(name)):
                spark.createDataFrame([], ddl).write.format(fmt).saveAsTable(self._name(name))

    def _name(self, table: str) -> str:
        return f"{self.db}.{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def compact(self, name: str, rows_per_file: int = 5_000_000) -> None:
        """Rewrite one store table into few files (the appends leave one small file per
        batch): write a compacted copy, then swap it in. Not atomic: run it while no
        writer appends to that table."""
        full, tmp = self._name(name), self._name(f"{name}__compact")
        src = self.table(name)
        files = max(1, -(-src.count() // rows_per_file))
        if self.spark.catalog.tableExists(tmp):
            self.spark.sql(f"DROP TABLE {tmp}")
        src.coalesce(files).write.format(self.fmt).saveAsTable(tmp)
        self.spark.sql(f"DROP TABLE {full}")
        self.spark.sql(f"ALTER TABLE {tmp} RENAME TO {full}")

    def _append(self, name: str, rows: list[tuple]) -> None:
        """Rows in the order of the table's columns."""
        if not rows:
            return
        if self._held is not None:
            self._held.setdefault(name, []).extend(rows)
            return
        frame = self.spark.createDataFrame(rows, _STORE_TABLES[name]).coalesce(1)
        if self.fmt != "parquet":
            frame.write.mode("append").format(self.fmt).saveAsTable(self._name(name))
            return
        # two writers cannot append files to one folder at once: each writes a folder of its own, whose files,
        # named apart by Spark, are then moved to the table
        staged = f"{self._root()}/_staged/{uuid.uuid4().hex}"
        frame.write.parquet(staged)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._name(name)}").where("col_name = 'Location'").first()[1]
        fs, source = self._path(staged)
        for status in fs.listStatus(source):
            if status.getPath().getName().startswith("part-"):
                if not fs.rename(status.getPath(), self._path(f"{described}/{status.getPath().getName()}")[1]):
                    raise OSError(f"{status.getPath()} was not moved to {described}")
        fs.delete(source, True)
        self.spark.catalog.refreshTable(self._name(name))

    def _root(self) -> str:
        return self.spark.catalog.getDatabase(self.db).locationUri.rstrip("/")

    def _path(self, path: str):
        """(file system, path) as Spark's Hadoop settings give it."""
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), made

    def _pending(self, name: str) -> list[tuple]:
        return (self._held or {}).get(name, [])

    @contextmanager
    def batch(self):
        """Hold rows back and write each table once at the end; nothing is written on an error."""
        if self._held is not None:
            yield self
            return
        self._held = {}
        try:
            yield self
            held = self._held
        finally:
            self._held = None
        with ThreadPoolExecutor(max_workers=max(1, min(4, len(held)))) as pool:
            list(pool.map(lambda item: self._append(*item), held.items()))

    @staticmethod
    def _now() -> int:
        return time.time_ns() // 1_000_000

    def _seq(self) -> int:
        """Grows with every row that this store writes, and with time across stores."""
        self._last_seq = max(self._last_seq + 1, time.time_ns())
        return self._last_seq

    # experiments -----------------------------------------------------
    def create_experiment(self, name: str, tags: dict | None = None) -> str:
        """Experiment id for ``name``, created on first use."""
        found = self.table("experiments").where(F.col("name") == name).select("experiment_id").limit(1).collect()
        found = [tuple(r) for r in found] or [r for r in self._pending("experiments") if r[1] == name]
        exp_id = found[0][0] if found else uuid.uuid4().hex
        if not found:
            self._append("experiments", [(exp_id, name, self._now(), "active")])
        if tags:
            self.set_experiment_tags(exp_id, tags)
        return exp_id

    def set_experiment_tags(self, experiment_id: str, tags: dict) -> None:
        now = self._now()
        self._append("experiment_tags", [(experiment_id, k, str(v), now, self._seq()) for k, v in tags.items()])

    def search_experiments(self, key: str, value: str) -> DataFrame:
        return experiments_by_tag(self.table("experiments"), self.table("experiment_tags"), key, value)

    # runs ------------------------------------------------------------
    def start_run(self, experiment_id: str, run_name: str, parent_run_id: str | None = None, tags: dict | None = None) -> str:
        """Id of a new run; ``tags`` (such as a code version) are set at its start."""
        run_id = uuid.uuid4().hex
        now = self._now()
        uri = f"{self.artifact_root.rstrip('/')}/{run_id}/artifacts" if self.artifact_root else None
        with self.batch():
            self._append("runs", [(run_id, experiment_id, run_name, "RUNNING", now, None, uri, "active", now, self._seq())])
            tags = {**(tags or {}), **({PARENT_TAG: parent_run_id} if parent_run_id else {})}
            if tags:
                self.set_tags(run_id, tags)
        return run_id

    def _run_row(self, run_id: str) -> tuple | None:
        """The current row of a run, held back or written."""
        held = [r for r in self._pending("runs") if r[0] == run_id]
        if held:
            return held[-1]
        mine = self.table("runs").where(F.col("run_id") == run_id)  # pushed to the scan
        row = upsert_latest(mine, ["run_id"], "updated", tiebreak=["seq"]).select(*mine.columns).first()
        return None if row is None else tuple(row)

    def end_run(self, run_id: str, status: str = "FINISHED") -> None:
        row = self._run_row(run_id)
        if row is None:
            raise KeyError(run_id)
        now = self._now()
        self._append("runs", [(*row[:3], status, row[4], now, *row[6:8], now, self._seq())])

    def log_document(self, run_id: str, name: str, doc: dict) -> str:
        """Write a JSON document under the run's artifact folder (shared storage) and return its path."""
        row = self._run_row(run_id)
        if row is None or row[6] is None:
            raise ValueError("the store has no artifact_root, or the run is unknown")
        path = f"{row[6]}/{name}"
        self.spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    def runs(self) -> DataFrame:
        """Current state of every run."""
        return upsert_latest(self.table("runs"), ["run_id"], "updated", tiebreak=["seq"]).drop("seq")

    def search_runs(self, **conditions) -> DataFrame:
        """``search_runs`` over the store's tables."""
        return search_runs(self.runs(), self.table("metrics"), self.tags(), params=self.table("params"),
                           experiments=self.table("experiments"), **conditions)

    # metrics / params / tags -----------------------------------------
    def log_metrics(self, run_id: str, metrics, step: int = 0) -> None:
        """``metrics``: a dict, or a DataFrame of (key, value) rows, a few per class."""
        now = self._now()
        if not isinstance(metrics, dict):
            metrics = {r["key"]: r["value"] for r in metrics.select("key", "value").collect()}
        self._append("metrics", [(run_id, k, now, float(v), int(step)) for k, v in metrics.items()])

    def log_params(self, run_id: str, params: dict) -> None:
        held = {(r[0], r[1]): r[2] for r in self._pending("params")}
        new = {k: str(v) for k, v in params.items()}
        bad = [(run_id, k, held[run_id, k], v) for k, v in new.items() if held.get((run_id, k), v) != v]
        if bad:
            raise ParamConflictError(bad)
        fresh = [(run_id, k, v) for k, v in new.items() if (run_id, k) not in held]
        if fresh:
            logged = self.table("params").where(F.col("run_id") == run_id)  # pushed to the scan
            rows = params_to_append(logged, self.spark.createDataFrame(fresh, _STORE_TABLES["params"])).collect()
            self._append("params", [tuple(r) for r in rows])

    def set_tags(self, run_id: str, tags: dict) -> None:
        now = self._now()
        self._append("tags", [(run_id, k, str(v), now, self._seq()) for k, v in tags.items()])

    def tags(self) -> DataFrame:
        return upsert_latest(self.table("tags"), ["run_id", "key"], "ts", tiebreak=["seq"]).drop("ts", "seq")

    def run_data(self, run_id: str) -> dict:
        """{'metrics': {...}, 'params': {...}, 'tags': {...}} of one run (bounded by its key count)."""
        pick = lambda df: df.where(F.col("run_id") == run_id)
        m = {r.key: r.value for r in latest_metrics(pick(self.table("metrics"))).collect()}
        p = {r.key: r.value for r in pick(self.table("params")).collect()}
        t = {r.key: r.value for r in pick(self.tags()).collect()}
        return {"metrics": m, "params": p, "tags": t}

    # datasets --------------------------------------------------------
    def log_input(self, run_id: str, profile_row, digest: str, context: str, table: str | None = None) -> None:
        """Record the dataset that a run consumed; ``table`` is the full name it can be read by."""
        known = self.table("datasets").where(F.col("digest") == digest).limit(1).count()
        if not known and not any(r[0] == digest for r in self._pending("datasets")):
            p = profile_row
            row = (digest, p["name"], "table", table or p["name"], p["schema"], p["num_rows"], p["num_elements"])
            self._append("datasets", [row])
        self._append("inputs", [(run_id, digest, context)])

    def load_input(self, run_id: str, context: str = "training") -> DataFrame:
        """The dataset that a run consumed, read from the table it was recorded with."""
        mine = run_inputs(self.table("inputs"), self.table("datasets"), run_id)
        row = mine.where(F.col("context") == context).select("source").first()
        if row is None:
            raise KeyError(f"run {run_id} has no {context} input")
        return self.spark.table(row["source"])

    # registry --------------------------------------------------------
    def register_model(self, name: str, run_id: str, source: str, tags: dict | None = None,
                       signature: str | None = None, input_example: str | None = None) -> int:
        """Append the next version of ``name`` and return its number. ``signature`` is the model's
        input contract and ``input_example`` a row that meets it, both as JSON.

        The number is claimed by a file that only one writer can create, beside the tables, so writers that
        register at the same time get different numbers; a writer that fails after its claim leaves a gap."""
        top = self.table("model_versions").where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        version = max([top, *(r[1] for r in self._pending("model_versions") if r[0] == name)]) + 1
        while not self._claimed(name, version):
            version += 1
        labels = {k: str(v) for k, v in (tags or {}).items()}
        self._append("model_versions", [(name, version, run_id, source, self._now(), "READY", labels, signature, input_example)])
        return version

    def _claimed(self, name: str, version: int) -> bool:
        """Create the claim of a version; False if another writer has it."""
        fs, path = self._path(f"{self._root()}/_claims/{hashlib.sha256(name.encode()).hexdigest()}/{version}")
        fs.mkdirs(path.getParent())
        try:
            if fs.getScheme() == "file":  # Hadoop's local file system checks and creates in two steps
                os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            else:
                fs.create(path, False).close()
        except FileExistsError:
            return False
        except Exception:
            if fs.exists(path):
                return False
            raise
        return True

    def set_alias(self, name: str, alias: str, version: int) -> None:
        check_alias(alias)
        self._append("model_aliases", [(name, alias, int(version), self._now(), self._seq())])

    def resolve(self, name: str, alias: str):
        """The version an alias points to, with the run that made it and its artifacts (raises when absent)."""
        got = resolve_alias(self.table("model_aliases"), self.table("model_versions"), name, alias, self.runs()).first()
        if got is None:
            raise KeyError(f"{name}@{alias}")
        return got
