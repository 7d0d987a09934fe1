import random
import re

from tabula.llm import decontaminate
from tabula.llm.common import ascii_lower
from tests.llm.cases import LONG, awkward, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            x = words(item)
            n = min(10, len(x))
            windows = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    found.add(str(item_id))
        out[doc_id] = (len(w), len(hit), sorted(found), bool(hit))
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect()}


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([30, 25, 12, 10, 9, 5, 4, 3, 1])] + [(90, None), (91, ""), (0, "w1 w1")]
    items += [(92, items[0][1]), (93, "same same same same same same same same same same same same")]
    docs = []
    for i in range(60):
        body = say(rng.choice([0, 3, 20, 150, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            x = words(rng.choice(items)[1])
            a = rng.randrange(len(x) + 1)
            at = rng.randrange(len(body) + 1)
            body[at:at] = x[a : a + rng.choice([4, 9, 10, 11, 30])]
        docs.append((i, ", ".join(body).upper() if i % 3 else " ".join(body)))
    docs.append((99, "same " * 500))
    got = rows(decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items)


def test_block_borders_and_shuffled_join(spark, monkeypatch):
    item = " ".join(f"b{i}" for i in range(14))
    docs = [(n, " ".join([f"x{j}" for j in range(n)] + words(item) + [f"y{j}" for j in range(n % 7)])) for n in range(0, 40)]
    make = lambda: decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"),
        stride=12)
    want = brute(docs, [(1, item)])
    assert rows(make()) == want
    monkeypatch.setattr(decontaminate, "ROW_BYTES", 1 << 40)
    assert rows(make()) == want


def test_awkward_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and runs"), (2, None), (None, "zeta eta")],
                                  "item_id long, text string")
    got = rows(decontaminate.decontaminate(awkward(spark), items))
    assert got[1] == (15, 10, ["1"], True) and got[6] == (30, 10, ["1"], True)
    assert got[2] == got[3] == got[4] == (0, 0, [], False)
    assert got[5] == (len(LONG.split()), 0, [], False) and got[None][3] is False
    none = items.where("false")
    assert rows(decontaminate.decontaminate(awkward(spark), none))[1] == (15, 0, [], False)
    assert rows(decontaminate.decontaminate(empty(spark), items)) == {}
    plan = decontaminate.report(awkward(spark), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ascii_lower_is_exact_and_translates_other_texts_only(spark):
    texts = ["ABC xyz 09", "ÉA", "İZ", "ΣAΣ", "KK", "", None, "a\U0001d400B"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", ascii_lower("text").alias("low"))
    table = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    assert {r.text: r.low for r in df.collect()} == {t: t and t.translate(table) for t in texts}
    assert "lower(" in df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_counted_without_being_made(spark):
    texts = ["One Été TWO,three-4", "  ", None, "İx Y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([("i", "y")], "item_id string, text string")
    out = decontaminate.decontaminate(docs, bench)
    assert {r.doc_id: (r.n_words, r.n_hit) for r in out.collect()} == {0: (5, 0), 1: (0, 0), 2: (0, 0), 3: (2, 1)}
    counted = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "n_words" in x and "sum(" in x]
    assert counted and "regexp_extract_all(text" in counted[0]
