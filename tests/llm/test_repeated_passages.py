import hashlib
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from tabula.llm import repeated_passages as rp
from tests.llm.cases import awkward, empty

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    words = [(d, SPLIT.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect())


def corpus(seed=2):
    rng = random.Random(seed)
    some = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passages = [some(rng.choice([49, 50, 51, 70, 120, 400])) for _ in range(12)]
    texts = []
    for _ in range(160):
        w = some(rng.choice([0, 5, 60, 200]))
        for _ in range(rng.randrange(3)):
            w += rng.choice(passages) + some(rng.choice([0, 1, 40]))
        texts.append(w)
    base = some(300)
    for _ in range(80):  # near copies, edited at random places
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(300)] = f"e{rng.randrange(5)}"
        texts.append(own)
    texts += [list(passages[5])] * 60 + [["a"] * 700, ["a"] * 60, ["x", "y", "z"] * 90, ["y", "z", "x"] * 40]
    ids = rng.sample(range(-500, 5000), len(texts))
    return [(d, rng.choice([" ", "\n", "  "]).join(w)) for d, w in zip(ids, texts, strict=True)]


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert got(rp.remove_repeats(df)) == want
    # many blocks, and several automata in each
    assert got(rp.remove_repeats(df, block_bytes=20_000, phrases=7)) == want
    assert got(rp.remove_repeats(df, window=20, gram=7, cell=5, block_bytes=50_000)) == brute(rows, 20)


def test_blocks_are_not_shuffled_again(spark):
    rows = [(i, " ".join(f"w{i * j % 977}" for j in range(80))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plan = rp.remove_repeats(df, block_bytes=2000)._jdf.queryExecution().executedPlan().toString()
    last = plan[plan.index("FlatMapCoGroups") :]
    assert "SelectedBucketsCount" in last and "Bucketed: true" in last
    texts = [line for line in plan.split("\n") if "Exchange" in line and "text" in line]
    assert not texts


def test_repeated_ids_and_nulls(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(3, words), (3, words), (3, "x " + words), (5, words + " y"), (None, words), (None, words), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(rp.remove_repeats(df)) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("b", F.lit(1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(rp.remove_repeats(docs)) == brute(rows)
    assert rp.remove_repeats(empty(spark)).count() == 0


def test_monotone_text_takes_seconds():
    own = rp.Passages([(1, b"a " * 113)])
    words, gone = own.numbered([b"a"] * 200_000), np.zeros(200_000, bool)
    began = time.time()
    for automaton in own.automata():
        own.mark(automaton, 2, words, gone)
    assert gone.all() and time.time() - began < 20
