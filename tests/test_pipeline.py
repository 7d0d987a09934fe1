import json
import os

import pytest
from pyspark.sql import functions as F

from tabula.operators import tables, train
from tabula.operators.runlog import RunStore, relative_bound_ms, search_runs
from tabula.plans.pipeline import prepare, score_alias, train_register
from tabula.sources import read_csv_text
from tabula.spec import BOOKINGS
from tests.test_features import booking_rows


def test_end_to_end(spark, tmp_dir):
    raw_path = os.path.join(tmp_dir, "bookings_csv")
    tables.write_csv(spark.createDataFrame(booking_rows(150)), raw_path)
    raw = read_csv_text(spark, raw_path)
    tr_name, te_name = prepare(raw, BOOKINGS, "tabula_e2e", month_col="arrival_month")
    assert spark.table(te_name).count() == 30 and spark.table(tr_name).count() == 120
    store = RunStore(spark, "tabula_e2e_runs", artifact_root=os.path.join(tmp_dir, "artifacts"))
    exp = store.create_experiment("/Shared/bookings", {"repository_name": "demo"})
    assert store.create_experiment("/Shared/bookings") == exp
    assert [r.experiment_id for r in store.search_experiments("repository_name", "demo").collect()] == [exp]
    params = train.BoostParams(max_iter=5, max_depth=3, min_instances_per_node=1)
    first = train_register(spark, store, BOOKINGS, tr_name, te_name, "bookings_model", os.path.join(tmp_dir, "m"), params,
                           tags={"git_sha": "abc"})
    second = train_register(spark, store, BOOKINGS, tr_name, te_name, "bookings_model", os.path.join(tmp_dir, "m"), params)
    assert (first["version"], second["version"]) == (1, 2)
    assert store.resolve("bookings_model", "latest-model").version == 2
    from tabula.operators.runlog import versions_of

    mv = store.table("model_versions")
    assert versions_of(mv, "bookings_model", tags={"git_sha": "abc"}).first().version == 1
    assert versions_of(mv, run_id=second["run_id"]).first().version == 2
    data = store.run_data(second["run_id"])
    assert "accuracy" in data["metrics"] and data["params"]["max_iter"] == "5"
    runs = store.runs()
    assert runs.where("status = 'FINISHED'").count() == 2
    newest = search_runs(runs, status="FINISHED", started_after_ms=relative_bound_ms(3600)).count()
    assert newest == 2
    tagged = store.search_runs(tag_eq={"git_sha": "abc"})
    assert [r.run_id for r in tagged.collect()] == [first["run_id"]]
    assert store.load_input(second["run_id"]).count() == 120
    got = store.resolve("bookings_model", "latest-model")
    assert got.run_id == second["run_id"] and got.artifact_uri.endswith(f"{second['run_id']}/artifacts")
    assert "lead_time" in json.loads(got.input_example) and "lead_time" in got.signature
    wrong = spark.table(te_name).withColumn("lead_time", F.lit("soon"))
    with pytest.raises(Exception) as e:
        score_alias(store, "bookings_model", "latest-model", wrong, BOOKINGS, keep=["Booking_ID"])
    assert "lead_time" in str(e.value) and "CAST_INVALID_INPUT" not in str(e.value)
    with pytest.raises(KeyError):
        score_alias(store, "bookings_model", "latest-model", wrong.drop("lead_time"), BOOKINGS)
    test = spark.table(te_name).drop("booking_status")
    scored = score_alias(store, "bookings_model", "latest-model", test, BOOKINGS, keep=["Booking_ID"])
    assert scored.count() == test.count()
    assert scored.select(F.countDistinct("Booking_ID")).first()[0] == 30
    assert store.table("inputs").count() == 2 and store.table("datasets").count() == 1
    doc_path = store.log_document(second["run_id"], "run_info.json", {"metrics": data["metrics"]})
    # read back as text: the metric keys differ only in case, which JSON schema inference rejects
    assert json.loads(spark.read.text(doc_path).first().value)["metrics"] == data["metrics"]
    assert data["tags"]["data_version"] == "0"
    prepare(raw, BOOKINGS, "tabula_e2e", month_col="arrival_month")  # republish -> version 1
    assert tables.current_version(spark, "tabula_e2e.table_versions", tr_name) == 1
