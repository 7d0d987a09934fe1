import random
import re

import numpy as np

from tabula.llm import near_dedup
from tabula.llm.common import workspace
from tabula.llm.components import connected
from tests.llm.cases import awkward, empty

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    sets = {}
    for doc_id, text in docs:
        w = SPLIT.findall((text or "").translate(LOWER))
        n = min(5, len(w))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def corpus(seed=5, families=12):
    rng = random.Random(seed)
    docs, n = [], 0
    passage = [f"p{i}" for i in range(60)]
    for f in range(families):
        base = [f"f{f}w{rng.randrange(500)}" for _ in range(rng.choice([6, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5, 15])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(9999)}"
            docs.append((n, " ".join(own).upper() if rng.random() < 0.2 else "  ".join(own)))
            n += 1
    for _ in range(25):  # many texts share a passage, but are not alike
        docs.append((n, " ".join(passage + [f"o{rng.randrange(10**6)}" for _ in range(40)])))
        n += 1
    # a chain: neighbours are alike, its ends are not
    chain = [f"c{i}" for i in range(100)]
    for _ in range(12):
        docs.append((n, " ".join(chain)))
        chain[:6], n = [], n + 1
        chain += [f"d{n}x{i}" for i in range(6)]
    docs += [(n, "one two"), (n + 1, "ONE  two"), (n + 2, "one two three"), (n + 3, ""), (n + 4, None), (n + 5, " ")]
    rng.shuffle(docs)
    return docs


def test_matches_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(near_dedup.near_duplicates(df)) == brute(docs)
    assert rows(near_dedup.near_duplicates(df, block=4, block_bytes=4000)) == brute(docs)


def test_links_at_the_threshold_are_found():
    """Pairs of similarity 0.75 exactly meet in a table."""
    rng, missed = np.random.default_rng(1), 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64)
        cut = 200 // 7  # (200 - cut) / (200 + cut) is 0.75
        y = np.concatenate([x[cut:], rng.integers(0, 1 << 63, cut, dtype=np.int64).astype(np.uint64)])
        (a, s), (b, t) = near_dedup.sketch(np.unique(x)), near_dedup.sketch(np.unique(y))
        same, half = a == b, near_dedup.HALVES
        agree = np.mean(np.frombuffer(s, np.uint8) == np.frombuffer(t, np.uint8))
        missed += not (same[:half].any() and same[half:].any() and agree >= near_dedup.SIGN_SHARE)
    assert missed <= 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), workspace(spark, "cc")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    assert got == {x: find(x) for x in root}
    none = spark.createDataFrame([], "a long, b long")
    assert connected(none, workspace(spark, "cc")).count() == 0


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(awkward(spark)).collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got}
    assert by[6].component_id == 1 and not by[6].kept and by[1].kept
    assert by[2].kept and by[3].n_shingles == 0 and by[4].component_id == 4
    assert by[5].n_shingles == 10 and by[None].component_id is None and by[None].kept
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
