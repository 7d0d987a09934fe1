import os

import pytest
from pyspark.sql import functions as F

from tabula.operators import runlog
from tabula.sources import scan_registry, scan_run_tree


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


#: child run -> (loss, gain) of a made-up sweep
SWEEP = {"shallow": (0.82, 11.0), "wide": (0.64, 17.5), "deep": (0.31, 14.25)}


def make_tree(root):
    exp = os.path.join(root, "100")
    write(os.path.join(exp, "meta.yaml"), "artifact_location: file:///x\ncreation_time: 5\nexperiment_id: '100'\nlifecycle_stage: active\nname: /Shared/demo\n")
    write(os.path.join(exp, "sweep", "meta.yaml"), "run_id: sweep\nexperiment_id: '100'\nrun_name: sweep of settings\nstatus: 3\nstart_time: 10\nend_time: 20\nartifact_uri: file:///a\nlifecycle_stage: active\n")
    for i, (name, (loss, gain)) in enumerate(SWEEP.items()):
        run = os.path.join(exp, name)
        write(os.path.join(run, "meta.yaml"), f"run_id: {name}\nexperiment_id: '100'\nrun_name: try {name}\nstatus: 3\nstart_time: {40 + i}\nend_time: 90\nartifact_uri: file:///c\nlifecycle_stage: active\n")
        write(os.path.join(run, "tags", runlog.PARENT_TAG), "sweep")
        write(os.path.join(run, "metrics", "loss"), f"100 {loss} 0\n")
        write(os.path.join(run, "metrics", "train", "gain"), f"100 {gain} 0\n")
        write(os.path.join(run, "metrics", "val loss"), "100 1.0 0\n")
        write(os.path.join(run, "params", "opt", "lr"), str(i))
        write(os.path.join(run, "artifacts", "metrics", "notes.txt"), "no numbers here\n")
    model = os.path.join(root, "models", "m", "version-1")
    write(os.path.join(model, "meta.yaml"), "aliases: []\ncreation_timestamp: 3\nname: m\nrun_id: deep\nsource: s\nstatus: READY\nversion: 1\n")
    hist = os.path.join(exp, "hist")
    write(os.path.join(hist, "meta.yaml"), "run_id: hist\nexperiment_id: '100'\nrun_name: h\nstatus: 3\nstart_time: 50\nend_time: 60\nartifact_uri: file:///h\nlifecycle_stage: active\n")
    write(os.path.join(hist, "metrics", "metric1"), "1 3.0 0\n2 3.5 1\n3 4.0 2\n")
    write(os.path.join(hist, "inputs", "in1", "meta.yaml"), "destination_id: hist\nsource_id: ds1\nsource_type: DATASET\ntags:\n  mlflow.data.context: training\n")
    write(os.path.join(exp, "datasets", "ds1", "meta.yaml"), "digest: f9c40f61\nname: train_set\nprofile: '{\"num_rows\": 1451, \"num_elements\": 30471}'\nschema: '{\"a\":\n  1}'\nsource_type: code\n")
    return root


def test_scan_tree_and_goldens(spark, tmp_dir):
    t = scan_run_tree(spark, make_tree(os.path.join(tmp_dir, "runs")))
    assert sorted(r.run_id for r in t.runs.collect()) == ["deep", "hist", "shallow", "sweep", "wide"]
    assert t.runs.where("run_id = 'sweep'").first().status == "FINISHED"
    latest = {r.key: r.value for r in runlog.latest_metrics(t.metrics).where("run_id = 'hist'").collect()}
    assert latest == {"metric1": 4.0}
    assert {r.key for r in t.metrics.where("run_id = 'deep'").collect()} == {"loss", "train/gain", "val loss"}
    wide = runlog.child_metrics_wide(t.runs, t.tags, t.metrics, ["loss", "train/gain"])
    assert {r.run_id: (r.loss, r["train/gain"]) for r in wide.collect()} == SWEEP
    best = runlog.best_child(wide, "loss", maximize=False).first()
    assert (best.parent_run_id, best.best_run_id, best.best_value) == ("sweep", "deep", 0.31)
    ds = t.datasets.first()
    assert (ds.num_rows, ds.num_elements, ds.digest) == (1451, 30471, "f9c40f61")
    inp = runlog.run_inputs(t.inputs.withColumnRenamed("dataset_id", "dataset_digest"),
                            t.datasets.drop("digest").withColumnRenamed("dataset_id", "digest"), "hist").first()
    assert inp.context == "training" and inp.name == "train_set"
    assert t.experiments.first().name == "/Shared/demo"
    maps = {r.run_id: r.params for r in runlog.kv_maps(t.params, "params").collect()}
    assert maps["deep"] == {"opt/lr": "2"}
    beside, _ = scan_registry(spark, os.path.join(tmp_dir, "runs", "models"))
    assert [(r.name, r.version, r.run_id) for r in beside.collect()] == [("m", 1, "deep")]


def test_search_and_newest(spark):
    runs = spark.createDataFrame(
        [("a", "e1", "x-run", "FINISHED", 100), ("b", "e1", "y-run", "FINISHED", 300), ("c", "e2", "x-run", "FAILED", 200)],
        "run_id string, experiment_id string, run_name string, status string, start_time long",
    )
    metrics = spark.createDataFrame([("a", "acc", 1, 0.9, 0), ("b", "acc", 1, 0.5, 0), ("a", "acc", 2, 0.2, 1)],
                                    "run_id string, key string, ts long, value double, step long")
    tags = spark.createDataFrame([("a", "sha", "1"), ("b", "sha", "2")], "run_id string, key string, value string")
    hit = runlog.search_runs(runs, metrics, tags, status="FINISHED", name_like="%run", started_after_ms=50,
                             metric_gt={"acc": 0.3}, tag_ne={"sha": "1"})
    assert [r.run_id for r in hit.collect()] == ["b"]
    assert runlog.newest(runs).first().run_id == "b"
    none = runlog.search_runs(runs, tags=tags, tag_ne={"sha": "x"}, experiment_ids=["e2"])
    assert none.count() == 0  # tag must exist for !=


def test_params_conflict_and_aliases(spark):
    existing = spark.createDataFrame([("r", "lr", "0.1")], "run_id string, key string, value string")
    ok = spark.createDataFrame([("r", "lr", "0.1"), ("r", "depth", "8")], "run_id string, key string, value string")
    assert [r.key for r in runlog.params_to_append(existing, ok).collect()] == ["depth"]
    bad = spark.createDataFrame([("r", "lr", "0.2")], "run_id string, key string, value string")
    with pytest.raises(runlog.ParamConflictError):
        runlog.params_to_append(existing, bad)
    with pytest.raises(ValueError):
        runlog.check_alias("latest")


def test_registry_versions_and_alias(spark, tmp_dir):
    root = os.path.join(tmp_dir, "models", "m")
    write(os.path.join(root, "meta.yaml"), "aliases:\n  latest-model: '2'\nname: cat.sch.model\n")
    for v in (1, 2):
        write(os.path.join(root, f"version-{v}", "meta.yaml"),
              f"aliases: []\ncreation_timestamp: {v * 10}\nname: cat.sch.model\nrun_id: run{v}\nsource: s{v}\nstatus: READY\nversion: {v}\n")
    write(os.path.join(root, "aliases", "latest-model"), "2")
    versions, aliases = scan_registry(spark, os.path.join(tmp_dir, "models"))
    assert versions.count() == 2
    aliases = aliases.withColumn("ts", F.lit(1).cast("long"))
    got = runlog.resolve_alias(aliases, versions, "cat.sch.model", "latest-model").first()
    assert (got.version, got.run_id) == (2, "run2")
    new = spark.createDataFrame([("cat.sch.model", 30, "run3"), ("other", 5, "run9")], "name string, created long, run_id string")
    numbered = {r.run_id: r.version for r in runlog.assign_versions(new, versions, ["created"]).collect()}
    assert numbered == {"run3": 3, "run9": 1}
    assert runlog.versions_of(versions, "cat.sch.model").count() == 2


def test_upsert_last_write_wins(spark):
    rows = spark.createDataFrame([("e", "k", "old", 1), ("e", "k", "new", 2), ("e", "j", "x", 1)],
                                 "experiment_id string, key string, value string, ts long")
    got = {r.key: r.value for r in runlog.upsert_latest(rows, ["experiment_id", "key"], "ts").collect()}
    assert got == {"k": "new", "j": "x"}
    exps = spark.createDataFrame([("e", "demo")], "experiment_id string, name string")
    assert runlog.experiments_by_tag(exps, rows, "k", "new").count() == 1


def test_store_nested_runs(spark):
    store = runlog.RunStore(spark, "tabula_nested_runs")
    exp = store.create_experiment("/Shared/nested")
    parent = store.start_run(exp, "sweep of settings")
    ids = {}
    with store.batch():
        for name, (loss, gain) in SWEEP.items():
            ids[name] = store.start_run(exp, name, parent_run_id=parent, tags={"git_sha": f"sha-{name}"})
            store.log_metrics(ids[name], {"loss": loss, "gain": gain})
            store.log_params(ids[name], {"depth": 3})
            with pytest.raises(runlog.ParamConflictError):
                store.log_params(ids[name], {"depth": 4})
            store.end_run(ids[name])
        assert store.runs().count() == 1  # held back until the batch ends
    wide = runlog.child_metrics_wide(store.runs(), store.tags(), store.table("metrics"), ["loss", "gain"])
    assert wide.count() == 3
    best = runlog.best_child(wide, "gain").first()
    assert (best.parent_run_id, best.best_run_id, best.best_value) == (parent, ids["wide"], 17.5)
    assert len(store.table("metrics").inputFiles()) == 2  # that of the empty table, and one for the whole batch
    found = store.search_runs(experiment_names=["/Shared/nested"], status="FINISHED", metric_gt={"gain": 12, "loss": 0.5},
                              param_eq={"depth": "3"}, tag_eq={"git_sha": "sha-wide"}, lifecycle_stage="active")
    assert [r.run_id for r in found.collect()] == [ids["wide"]]
    assert store.search_runs(experiment_names=["other"]).count() == 0


def test_last_write_wins_within_a_millisecond(spark, monkeypatch):
    store = runlog.RunStore(spark, "tabula_ties")
    monkeypatch.setattr(runlog.RunStore, "_now", staticmethod(lambda: 1000))
    run = store.start_run("e", "r")
    store.end_run(run)
    store.set_tags(run, {"stage": "z"})
    store.set_tags(run, {"stage": "a"})
    store.set_alias("m", "champion", 2)
    store.set_alias("m", "champion", 1)
    store.register_model("m", run, "s1")
    store.register_model("m", run, "s2", signature="{}", input_example="{}")
    assert store.runs().first().status == "FINISHED"
    assert store.tags().first().value == "a"
    got = store.resolve("m", "champion")
    assert (got.version, got.source, got.run_name) == (1, "s1", "r")
    with pytest.raises(KeyError):
        store.resolve("m", "other")


def test_batch_of_params_may_not_contradict_itself(spark):
    ddl = "run_id string, key string, value string"
    none = spark.createDataFrame([], ddl)
    with pytest.raises(runlog.ParamConflictError):
        runlog.params_to_append(none, spark.createDataFrame([("r", "lr", "0.1"), ("r", "lr", "0.2")], ddl))
    same = spark.createDataFrame([("r", "lr", "0.1"), ("r", "lr", "0.1")], ddl)
    assert [tuple(r) for r in runlog.params_to_append(none, same).collect()] == [("r", "lr", "0.1")]


def test_time_bound_keeps_milliseconds():
    assert runlog.relative_bound_ms(1.5, now_ms=10_250) == 8_750


def test_store_compaction_keeps_rows(spark):
    store = runlog.RunStore(spark, "tabula_compact_runs")
    run = store.start_run("e", "r")
    for i in range(4):
        store.log_metrics(run, {"m": float(i)}, step=i)
    before = sorted(map(tuple, store.table("metrics").select("key", "value", "step").collect()))
    store.compact("metrics")
    after = sorted(map(tuple, store.table("metrics").select("key", "value", "step").collect()))
    assert before == after and len(after) == 4
    assert len(store.table("metrics").inputFiles()) == 1
    store.log_metrics(run, {"m": 9.0}, step=9)  # still appendable
    assert store.run_data(run)["metrics"] == {"m": 9.0}


def test_parallel_writers_get_versions_of_their_own(spark):
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    db = f"runlog_{uuid.uuid4().hex[:8]}"
    stores = [runlog.RunStore(spark, db) for _ in range(4)]
    jobs = [(s, name, i) for i in range(3) for s in stores for name in ("m", "a/b ü")]
    with ThreadPoolExecutor(8) as pool:
        given = list(pool.map(lambda j: (j[1], j[0].register_model(j[1], f"run-{j[2]}", "s")), jobs))
    for name in ("m", "a/b ü"):
        assert sorted(v for n, v in given if n == name) == list(range(1, 13))
        kept = stores[0].table("model_versions").where(F.col("name") == name).select("version").collect()
        assert sorted(r.version for r in kept) == list(range(1, 13))
