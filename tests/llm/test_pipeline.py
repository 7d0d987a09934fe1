import numpy as np

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tabula.llm import byte_bpe, quality_cotrain
from tests.llm import test_near_dedup, test_decontaminate, test_secrets
from tests.llm.cases import CLASHES, awkward, empty
from tests.llm.test_tokens import reference_encoding

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    docs = read("documents")
    model = quality_cotrain.train(docs, read("labels"))
    left = {r.doc_id: r for r in docs.collect()}
    assert {c for c in docs.columns} == set(left[0].asDict())
    left = {k: r.text for k, r in left.items() if model.score(r.text, r.lang, r.source, r.n_chars) >= quality_cotrain.THRESHOLD}
    groups = test_near_dedup.brute(list(left.items()))
    left = {k: t for k, t in left.items() if groups[k][2]}
    leaked = test_decontaminate.brute(list(left.items()), [(r.item_id, r.text) for r in read("benchmark").collect()])
    left = {k: t for k, t in left.items() if not leaked[k][3]}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(left) and 50 < len(left) < docs.count()
    for k, text in left.items():
        raw = text
        for span in reversed(test_secrets.brute(text)):
            a, b = map(int, span.split(":")[1:])
            raw = raw[:a] + "[SECRET]" + raw[b:]
        if len(test_secrets.brute(text)) <= 1:
            assert got[k].ids == reference_encoding().encode_ordinary(raw)
        assert got[k].round_trip and got[k].n_tokens == len(got[k].ids)


def test_every_stage_takes_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() > 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and set(CLASHES) <= set(out.columns)
            assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, empty(spark), SF).count() == 0


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    out = corpus_pipeline.near_duplicates(spark, awkward(spark), SF).select("doc_id").collect()
    ids = [r.doc_id for r in out]
    assert 6 not in ids and 1 in ids and None in ids and len(ids) == 8


def test_queries_are_registered():
    names = set(queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and set(oracle_sql()) <= names
    assert np.uint64 and byte_bpe.VOCABULARY


def test_stages_judge_rows_not_ids(spark, tmp_dir):
    """Of rows that share an id, or have none, only those whose own text is rejected go."""
    words = lambda k, n=40: " ".join(f"{k}w{i}" for i in range(n))
    leak = words("bench", 12)
    rows = [
        (1, words("a"), "en", "s", 1), (1, words("b") + " " + leak, "en", "s", 1), (2, words("a") + " end", "en", "s", 1),
        (2, words("c"), "en", "s", 1), (None, words("d"), "en", "s", 1), (None, words("e") + " " + leak, "en", "s", 1),
        (None, words("a"), "en", "s", 1), (3, None, None, None, None), (3, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([("x", leak)], "item_id string, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    left = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    text = lambda keep: sorted(((r[0], r[1]) for i, r in enumerate(rows) if i in keep), key=str)
    assert left(corpus_pipeline.decontamination(spark, docs, tmp_dir)) == text({0, 2, 3, 4, 6, 7, 8})
    assert left(corpus_pipeline.near_duplicates(spark, docs, tmp_dir)) == text({0, 1, 3, 4, 5, 6, 7, 8})
    model = quality_cotrain.CoTrained([(np.zeros(quality_cotrain.TEXT_SIZE), 0.0), (np.eye(1, quality_cotrain.META_SIZE, quality_cotrain.META_SIZE - 2)[0], -0.25)], [(1.0, 0.0)] * 2, (0.0, 9.0, 0.0))
    assert left(quality_cotrain.accepted(docs, model)) == text({7, 8})  # the rows of unknown length
