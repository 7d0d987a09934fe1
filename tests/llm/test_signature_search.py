import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabula.llm import signature_search as ss
from tests.llm.cases import awkward, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=10):
    tf = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    n_docs, total = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c in tf:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:top])]
    return out


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 4000}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 30, 200, 900])))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(n // 2)]  # a third of the rows is one text
    items = [(i, " ".join(rng.choices(vocabulary, k=25)) + "; " + docs[rng.randrange(n)][1][:60].upper()) for i in range(25)]
    return docs, items


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    asked = spark.createDataFrame(items + items[:2], "item_id long, text string")
    want = sorted(brute(docs, items), key=str)
    assert got(ss.search(df, asked)) == want
    blocks, merge, queries = ss.BLOCK, ss.MERGE, ss.QUERIES
    try:
        ss.MERGE, ss.QUERIES = 2, 10
        assert got(ss.search(df, asked)) == want
    finally:
        ss.BLOCK, ss.MERGE, ss.QUERIES = blocks, merge, queries


def test_bounds_never_miss_and_leave_most_out():
    docs, items = corpus(seed=4)
    counted = [(d, Counter(ss.terms(t))) for d, t in docs]
    df = Counter(t for _, c in counted for t in c)
    total = sum(c.total() for _, c in counted)
    weights = {t: ss.weight(len(counted), f) for t, f in df.items()}
    searcher = ss.Searcher([sorted(set(ss.terms(t))) for _, t in items], weights, len(counted), total, 10)
    for block in ss.blocks([(d, c, ss.entries(c)) for d, c in counted]):
        bounds = searcher.bounds(block)
        exact = np.array([[searcher.score(q, d[1]) for d in block] for q in range(len(items))])
        assert (bounds >= exact).all()
        searcher.add(block)
    assert 0 < searcher.scored < searcher.bounded / 3


def test_blocks_are_bounded():
    huge = (1, Counter(), np.zeros(1 << 22, np.uint64))
    small = [(i, Counter(), np.zeros(50, np.uint64)) for i in range(2000)]
    cut = ss.blocks([huge, *small, huge])
    assert sum(map(len, cut)) == 2002 and max(map(len, cut)) <= ss.BLOCK
    assert all(len(b) == 1 or len(b) * max(len(d[2]) for d in b) * ss.BITS <= ss.CELLS for b in cut)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("item_id", F.lit(1))
    items = [("a", "the QUICK fox, the größe"), ("a", "the QUICK fox, the größe"), ("b", None), ("c", ""), (None, "12345 words"), ("d", "nowhere")]
    asked = spark.createDataFrame(items, "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(ss.search(docs, asked)) == sorted(brute(rows, items), key=str)
    assert ss.search(empty(spark), asked).count() == 0
    assert ss.search(docs, asked.limit(0)).count() == 0
    assert ss.search(docs.where("doc_id = 4"), asked).count() == 0
