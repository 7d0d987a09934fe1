import zlib

import numpy as np

from tabula.llm import language_id
from tabula.llm.language_id import BiGru
from tests.llm.cases import awkward, empty


def test_gradients_match_differences():
    g = BiGru(["a", "b", "c"], hidden=3)
    g.p = {k: v.astype(np.float64) for k, v in g.p.items()}
    rows = np.random.default_rng(0).integers(0, 256, (4, 6)).astype(np.uint8)
    sizes, target = np.array([6, 4, 1, 5]), np.array([0, 1, 2, 1])
    _, grads = g.gradients(rows, sizes, target)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        loss = []
        for step in (1e-3, -2e-3):
            g.p[name][at] += step
            loss.append(g.gradients(rows, sizes, target)[0])
        g.p[name][at] += 1e-3
        assert abs(grad[at] - (loss[0] - loss[1]) / 2e-3) < 1e-4 * max(1, abs(grad[at]))


def test_pooling_reads_every_byte():
    g = BiGru(["a", "b"], hidden=4)
    texts = [b"x", b"abc" * 100, bytes(range(64)), bytes(range(65)), b""]
    pooled = g.pooled(texts, segment=64, side=3)
    for t, p in zip(texts, pooled):
        parts = [t[i : i + 64] for i in range(0, len(t), 64)]
        total = sum((g.positions(np.frombuffer(x, np.uint8)[None], np.array([len(x)]))[0].sum(0) for x in parts), np.zeros(2))
        assert np.allclose(p, total / max(1, len(t)), atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs, steps=250)
    got = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    out = [r.lang_pred == r.lang for r in got if r.held_out and r.lang]
    assert np.mean(out) >= 0.95, np.mean(out)


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.train(docs, steps=5)
    got = language_id.predict(docs, model).collect()
    assert len(got) == 10
    for r in got:
        unknown = r.doc_id in (2, 3, 4, 8)
        assert (r.lang_pred == "und") == unknown and (r.score == 0) == unknown
        assert r.lang_pred in {"und", *model.labels}
    assert language_id.train(empty(spark)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(empty(spark), model).count() == 0
