import json
import os

import pytest
from pyspark.sql import functions as F

from tabula import sources
from tabula.operators import tables
from tabula.sources import read_csv_inferred, read_csv_text, read_run_documents, row_range


def test_csv_round_trip_with_tokens(spark, tmp_dir):
    df = spark.createDataFrame([("1", "NA"), ("2", "x"), ("3", "None")], "id string, v string")
    path = os.path.join(tmp_dir, "csv")
    tables.write_csv(df, path)
    back = read_csv_text(spark, path, ["id", "v"])
    assert sorted((r.id, r.v) for r in back.collect()) == [("1", None), ("2", "x"), ("3", None)]
    assert dict(read_csv_inferred(spark, path).dtypes)["id"] == "int"
    assert row_range(spark, 5).count() == 5


def test_publish_append_properties(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tabula_t")
    flagged = spark.range(10).withColumn("is_test", F.col("id") < 3)
    tables.publish_split(flagged, "tabula_t.train_set", "tabula_t.test_set")
    assert tables.table_exists(spark, "tabula_t.train_set")
    assert spark.table("tabula_t.test_set").count() == 3
    assert "update_timestamp_utc" in spark.table("tabula_t.train_set").columns
    tables.enable_change_feed(spark, "tabula_t.train_set", "tabula_t.test_set")
    assert tables.table_properties(spark, "tabula_t.train_set")["delta.enableChangeDataFeed"] == "true"
    tables.append_table(spark.range(12).withColumn("update_timestamp_utc", F.current_timestamp()), "tabula_t.train_set", keys=["id"])
    assert spark.table("tabula_t.train_set").count() == 7 + 5  # 3..9 then 0,1,2,10,11


def test_run_documents_and_json_sink(spark, tmp_dir):
    doc = {
        "info": {"run_id": "r1", "experiment_id": "e", "status": "FINISHED", "start_time": 1, "end_time": 2,
                 "run_name": "n", "artifact_uri": "u", "lifecycle_stage": "active", "user_id": "x"},
        "data": {"metrics": {"m": 1.5}, "params": {"p": "3"}, "tags": {"t": "v"}},
    }
    p = os.path.join(tmp_dir, "run.json")
    with open(p, "w") as f:
        json.dump(doc, f, indent=4)
    r = read_run_documents(spark, p).first()
    assert r.run_id == "r1" and r.metrics == {"m": 1.5} and r.params == {"p": "3"}
    tables.write_json(read_run_documents(spark, p), os.path.join(tmp_dir, "out"))
    assert spark.read.json(os.path.join(tmp_dir, "out")).count() == 1


def test_explode_run_document_maps(spark, tmp_dir):
    from tabula.sources.documents import explode_map

    p = os.path.join(tmp_dir, "doc.json")
    with open(p, "w") as f:
        json.dump({"info": {"run_id": "r9"}, "data": {"metrics": {"a": 1.0, "b": 2.0}, "params": {}, "tags": {}}}, f)
    rows = sorted((r.key, r.value) for r in explode_map(read_run_documents(spark, p), "metrics").collect())
    assert rows == [("a", 1.0), ("b", 2.0)]


def test_columns_go_by_their_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    with open(path, "w") as f:
        f.write('id,name,v\n1,"a ""b"" c",x\n2, blank ,"p,q"\n')
    got = [tuple(r) for r in read_csv_text(spark, path, ["v", "name", "id"]).orderBy("id").collect()]
    assert got == [("x", 'a "b" c', "1"), ("p,q", " blank ", "2")]
    assert read_csv_text(spark, path, ["name"]).columns == ["name"]
    with pytest.raises(ValueError):
        read_csv_text(spark, path, ["id", "price"])


def test_files_with_another_header_are_refused(spark, tmp_dir):
    for name, text in (("a.csv", "id,v\n1,x\n"), ("b.csv", "v,id\ny,2\n")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception):
        read_csv_text(spark, tmp_dir, ["id", "v"]).collect()


def test_line_breaks_in_quotes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "n.csv")
    with open(path, "w") as f:
        f.write('id,v,w\n1,"two\nlines",x\n2,y,z\n')
    assert sorted(tuple(r) for r in read_csv_text(spark, path, multi_line=True).collect()) == [("1", "two\nlines", "x"), ("2", "y", "z")]
    with pytest.raises(Exception):
        read_csv_text(spark, path).select("id").collect()


def test_csv_sink_keeps_blanks_and_quotes(spark, tmp_dir):
    rows = [("1", ' lead "and" trail '), ("2", "a,b"), ("3", "back\\slash"), ("4", "two\nlines")]
    path = os.path.join(tmp_dir, "out")
    tables.write_csv(spark.createDataFrame(rows, "id string, v string"), path)
    assert sorted(tuple(r) for r in read_csv_text(spark, path, multi_line=True).collect()) == rows


def test_append_skips_null_keys_and_repeats(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tabula_t")
    rows = spark.createDataFrame([(1, "a"), (None, "n"), (2, "x"), (2, "y")], "k int, v string")
    spark.sql("DROP TABLE IF EXISTS tabula_t.keyed")
    for _ in range(2):
        tables.append_table(rows, "tabula_t.keyed", keys=["k"])
    got = sorted((str(r.k), r.v) for r in spark.table("tabula_t.keyed").collect())
    assert [k for k, _ in got] == ["1", "2", "None"] and got[1][1] in ("x", "y")


def test_publish_can_append(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tabula_t")
    flagged = spark.range(6).withColumn("is_test", F.col("id") < 2)
    tables.publish_split(flagged, "tabula_t.a_train", "tabula_t.a_test")
    tables.publish_split(spark.range(9).withColumn("is_test", F.col("id") < 2), "tabula_t.a_train", "tabula_t.a_test", mode="append", keys=["id"])
    assert sorted(r.id for r in spark.table("tabula_t.a_train").collect()) == [2, 3, 4, 5, 6, 7, 8]
    assert spark.table("tabula_t.a_test").count() == 2


def test_run_document_inputs(spark, tmp_dir):
    from tabula.sources.documents import explode_inputs

    dataset = {"digest": "d1", "name": "bookings", "source": "cat.sch.t", "source_type": "table"}
    doc = {"info": {"run_id": "r", "run_uuid": "u"}, "data": {},
           "inputs": {"dataset_inputs": [{"dataset": dataset, "tags": [{"key": "context", "value": "training"}]}]}}
    p = os.path.join(tmp_dir, "doc.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    docs = read_run_documents(spark, p)
    assert docs.first().run_uuid == "u"
    r = explode_inputs(docs).first()
    assert (r.run_id, r.digest, r.source, r.tags) == ("r", "d1", "cat.sch.t", {"context": "training"})


def test_csv_rejects_hold_every_line_that_does_not_fit(spark, tmp_dir):
    for name, lines in (("a.csv", ["id,name", "1,x", "2", "3,y,z", '4,"q,""r"""', "", "5,NA"]), ("b.csv", ["id,name", "6,w", "7"])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    good, rejects = sources.read_csv_checked(spark, tmp_dir, ["name", "id"])
    assert sorted((r["id"], r["name"]) for r in good.where("name is not null").collect()) == [("1", "x"), ("4", 'q,"r"'), ("6", "w")]
    assert [r.id for r in good.where("name is null").collect()] == ["5"]
    assert sorted((r.file[-5:], r.row) for r in rejects.collect()) == [("a.csv", "2"), ("a.csv", "3,y,z"), ("b.csv", "7")]
    with pytest.raises(ValueError):
        sources.read_csv_checked(spark, tmp_dir, ["nowhere"])


def test_document_shape_and_values(spark):
    rows = [(1, '{"a": {"b": 1}, "c": "x"}'), (2, '{"a": 5}'), (3, "{"), (4, None), (5, "[1]"), (6, '{"a": {"b": {"c": {"d": 1}}}}')]
    df = spark.createDataFrame(rows, "id long, doc string")
    got = {(r.path, r.kind): r.n for r in sources.document_shape(df, "doc", depth=3).groupBy("path", "kind").sum("n").toDF("path", "kind", "n").collect()}
    assert got[("$", "OBJECT")] == 3 and got[("invalid", "invalid")] == 1 and got[("$", "ARRAY")] == 1
    assert got[("$.a", "OBJECT")] == 2 and got[("$.a", "BIGINT")] == 1 and got[("$.a.b.c", "OBJECT")] == 1 and ("$.a.b.c.d", "BIGINT") not in got
    values = {r.id: (r.b, r.c) for r in sources.document_values(df, "doc", {"b": ("$.a.b", "bigint"), "c": ("$.c", "string")}, ["id"]).collect()}
    assert values == {1: (1, "x"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None)}
