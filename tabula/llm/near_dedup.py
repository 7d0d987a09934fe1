"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct ``WORDS``-word shingles (lower-cased A-Z), as 64-bit
hashes. Two groups of ``HALVES`` small collections of ``ROWS`` minhashes are taken from it;
a table key is a pair of one collection of each group, so ``HALVES``**2 tables of
2 * ``ROWS`` minhashes come from 2 * ``HALVES`` * ``ROWS`` hash functions instead of
2 * ``HALVES``**2 * ``ROWS``. Two sets of similarity s meet in a table with probability
(1 - (1 - s**ROWS)**HALVES)**2: 0.9998 at 0.75, and 0.99999 at 0.8.

1. Documents with equal sets are one class; its smallest id stands for it from then on.
2. Half keys that no other class has are dropped, since no table key over them can meet;
   only the others are combined. Buckets with the same members are taken once.
3. In every bucket the members are compared with its smallest member only (a star, so a
   bucket's rows stay linear). Pairs whose sizes cannot reach the similarity are dropped
   (exact), as are those whose 192 minhashes agree in less than ``SIGN_SHARE`` (4.8 standard
   deviations under the threshold); the others are alike, and their full sets decide whether
   they are linked.
4. Star pairs that agree in ``NEAR_SHARE`` at least join their documents to neighbourhoods. In one that still holds several
   components of links, members of different components are compared on their full sets, in
   blocks of about ``BLOCK_BYTES``; a block reports the links that join components, not all.
5. Members of one bucket but different neighbourhoods are compared by their minhashes, in
   blocks as well, and the pairs that are alike are confirmed on the full sets.

So every two linked documents that met in a bucket end in one component.

Documents without words are linked with nothing. Rows with a null id are linked with
nothing and kept. Ids are expected to be unique; rows that repeat an id carry each the
component of its own text.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import id_text, releasing, saved, slices, small_side, workspace
from tabula.llm.components import connected

WORDS = 5
PERCENT = 75
HALVES = 24
ROWS = 4
SIGN_SHARE = 0.6
#: Share of equal minhashes from which two documents count as neighbours.
NEAR_SHARE = 0.4
#: Packed sets of a block in step 4, and members of one in step 5.
BLOCK_BYTES = 4 << 20
BLOCK = 1024
#: Words a task remembers the hash of; over it, and when the task ends, the memory is emptied.
MEMORY = 200_000
#: Shingles whose minhashes are taken at once.
SIDE = 4096
_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _forget() -> None:
    _word_hashes().clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all bits of the input."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; of the whole sequence if it is shorter."""
    # bytes.lower and bytes.split treat exactly A-Z and the blanks 09-0D and 20
    own = text.encode().lower().split() if text else []
    known = _word_hashes()
    if len(known) > MEMORY:
        known.clear()
    h = np.fromiter(map(known.__getitem__, own), _U, len(own))
    if not len(h):
        return h
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, size, _U)
    for i in range(size):
        total = total * _U(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
    return np.unique(_mixed(total))


@lru_cache(maxsize=4)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    draw = lambda: rng.integers(0, 1 << 32, count, dtype=np.uint32)
    return draw() | np.uint32(1), draw()


def minhashes(own: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of each hash function, on the high half of the shingles' hashes."""
    factor, shift = _functions(count)
    high = (own >> _U(32)).astype(np.uint32)
    best = np.full(count, ~np.uint32(0))
    for start in range(0, len(own), SIDE):
        part = high[start : start + SIDE, None] * factor
        part += shift
        np.minimum(best, part.min(0), out=best)
    return best


def sketch(own: np.ndarray, halves: int = HALVES, rows: int = ROWS) -> tuple[np.ndarray, bytes]:
    """(half keys, first of one group, then of the other; a byte of every minhash)."""
    low = _mixed(minhashes(own, 2 * halves * rows).astype(_U) + _U(1))
    key = np.arange(2 * halves, dtype=_U)
    for column in low.reshape(2 * halves, rows).T:
        key = _mixed(key * _U(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64), (low >> _U(56)).astype(np.uint8).tobytes()


_SKETCH = "id long, n long, set_key binary, halves array<bigint>, sign binary, text_md5 string"


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Sketch rows of (id, text); a text without words has n = 0 and no keys."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own, md5 = shingles(text, words), None if text is None else hashlib.md5(text.encode()).hexdigest()
                    if len(own):
                        halves, sign = sketch(own)
                        key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                        out.append((doc_id, len(own), key, halves.tolist(), sign, md5))
                    else:
                        out.append((doc_id, 0, None, None, None, md5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _SKETCH_TYPES)], ["id", "n", "set_key", "halves", "sign", "text_md5"]
                )

    return docs.mapInArrow(releasing(run, _forget), _SKETCH)


_SKETCH_TYPES = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.string())


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, own): the packed shingle set of each document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 64):
                made = [shingles(t, words) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in made], pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())],
                    ["id", "n", "own"],
                )

    return docs.mapInArrow(releasing(run, _forget), "id long, n long, own binary")


def _bucket_members(reps: DataFrame, path: str, halves: int) -> DataFrame:
    """(bucket, rep, leader, size): members of the table buckets with several classes, each
    set of members once."""
    half = reps.select("rep", F.posexplode("halves").alias("i", "key"))
    shared = half.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("key")
    alive = half.join(shared, "key").groupBy("rep").agg(
        F.collect_list(F.when(F.col("i") < halves, F.col("key"))).alias("a"),
        F.collect_list(F.when(F.col("i") >= halves, F.col("key"))).alias("b"),
    )
    alive = saved(alive.where("size(a) > 0 and size(b) > 0"), f"{path}/alive")
    # explode_outer: for explode the optimizer adds a filter that computes the array once more
    table = alive.select("rep", F.explode_outer(F.expr("flatten(transform(a, x -> transform(b, y -> xxhash64(x, y))))")).alias("bucket"))
    buckets = table.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("rep").alias("leader"), F.bit_xor(F.xxhash64("rep")).alias("who")
    ).where("size > 1")
    once = buckets.groupBy("size", "leader", "who").agg(F.min("bucket").alias("bucket")).drop("who")
    return saved(table.join(once, "bucket"), f"{path}/members")


def _agreeing(pairs: DataFrame, share: float) -> DataFrame:
    """Pairs (a, b, n_a, n_b, agree) of a frame (a, b, n_a, n_b, sign_a, sign_b) whose minhashes agree in
    ``share`` at least."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, SIDE):
                left, right = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    for c in ("sign_a", "sign_b")
                )
                agree = (left == right).mean(1)
                keep, names = pa.array(agree >= share), ["a", "b", "n_a", "n_b"]
                columns = [part.column(c).filter(keep) for c in names] + [pa.array(agree).filter(keep)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "agree"])

    columns = ["a", "b", "n_a", "n_b", "sign_a", "sign_b"]
    return pairs.select(*columns).mapInArrow(run, "a long, b long, n_a long, n_b long, agree double")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, path: str) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity, with their shared and total counts."""
    pairs = saved(pairs, f"{path}/pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = saved(_sets(docs.join(small_side(ids, 16), "id", "left_semi"), words), f"{path}/sets")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 64):
                left, right = part.column("own_a").to_pylist(), part.column("own_b").to_pylist()
                both = [
                    len(np.intersect1d(np.frombuffer(x, _U), np.frombuffer(y, _U), assume_unique=True))
                    for x, y in zip(left, right)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), part.column("n_a"), part.column("n_b"), pa.array(both, pa.int64())],
                    ["a", "b", "n_a", "n_b", "n_both"],
                )

    a = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("own").alias("own_a"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("own").alias("own_b"))
    counted = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "own_a", "own_b").mapInArrow(
        run, "a long, b long, n_a long, n_b long, n_both long"
    )
    linked = counted.where(100 * F.col("n_both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("n_both")))
    return saved(linked.select("a", "b").distinct(), f"{path}/links")


def _inside(near: DataFrame, comps: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int,
            share: float, block_bytes: int) -> DataFrame:
    """Links (a, b) that join components of one neighbourhood; ``near`` has (node, root)."""
    own = near.select(F.col("node").alias("rep"), F.col("root").alias("near")).join(
        comps, F.col("rep") == F.col("node"), "left"
    ).select("rep", "near", F.coalesce("root", "rep").alias("comp"))
    own = own.join(reps.select("rep", "n", "sign"), "rep")
    mixed = own.groupBy("near").agg(
        F.min("comp").alias("_x"), F.max("comp").alias("_y"), F.ceil(F.sum("n") * 8 / block_bytes).cast("int").alias("blocks")
    ).where("_x <> _y").select("near", "blocks")
    own = own.join(mixed, "near")
    ids = own.select(F.col("rep").alias("id")).distinct()
    sets = _sets(docs.join(small_side(ids, 16), "id", "left_semi"), words).select(F.col("id").alias("rep"), "own")
    own = _paired(own.join(sets, "rep"), "near").select("near", "i", "j", "mine", "rep", "comp", "n", "sign", "own")

    def compare(pdf):
        import pandas as pd

        pdf = pdf.sort_values("rep", ignore_index=True)
        rep, n, mine = (pdf[c].to_numpy() for c in ("rep", "n", "mine"))
        comp = pd.factorize(pdf["comp"])[0]
        sets = [np.frombuffer(x, _U) for x in pdf["own"]]
        sign = np.frombuffer(b"".join(pdf["sign"]), np.uint8).reshape(len(pdf), -1)
        crossing, out = pdf["i"].iat[0] != pdf["j"].iat[0], []
        for x in range(len(pdf) - 1):
            y = slice(x + 1, None)
            ok = (comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))
            if crossing:
                ok &= mine[y] != mine[x]
            at = np.nonzero(ok)[0] + x + 1
            if not len(at):
                continue
            agree = (sign[at] == sign[x]).mean(1)
            at = at[agree >= share][np.argsort(-agree[agree >= share], kind="stable")]
            while len(at):
                z, at = at[0], at[1:]
                both = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                if 100 * both >= percent * (n[x] + n[z] - both):
                    out.append((rep[x], rep[z]))
                    comp[comp == comp[z]] = comp[x]  # from here on they are one
                    at = at[comp[at] != comp[x]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return own.groupBy("near", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _paired(own: DataFrame, group: str) -> DataFrame:
    """Rows of ``own``, whose groups are cut into ``blocks``, once for every pair (i, j) of blocks that
    theirs (``mine``) is part of: each pair of blocks is a group of its own, and no rows are paired."""
    own = own.withColumn("mine", F.pmod(F.xxhash64("rep", group), F.greatest("blocks", F.lit(1))).cast("int"))
    own = own.withColumn("other", F.explode_outer(F.expr("sequence(0, greatest(blocks, 1) - 1)")))
    return own.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))


def _across(members: DataFrame, near: DataFrame, reps: DataFrame, percent: int, share: float, block: int) -> DataFrame:
    """Alike pairs (a, b) of one bucket but different neighbourhoods."""
    own = members.join(near, members["rep"] == near["node"], "left").select(
        "bucket", "rep", "size", F.coalesce("root", "rep").alias("near")
    )
    mixed = own.groupBy("bucket").agg(F.min("near").alias("_x"), F.max("near").alias("_y")).where("_x <> _y").select("bucket")
    own = own.join(mixed, "bucket").join(reps.select("rep", "n", "sign"), "rep")
    own = own.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    own = _paired(own, "bucket").select("bucket", "i", "j", "mine", "rep", "near", "n", "sign")

    def compare(pdf):
        import pandas as pd

        pdf = pdf.sort_values("rep", ignore_index=True)
        rep, home, n, mine = (pdf[c].to_numpy() for c in ("rep", "near", "n", "mine"))
        sign = np.frombuffer(b"".join(pdf["sign"]), np.uint8).reshape(len(pdf), -1)
        crossing, out = pdf["i"].iat[0] != pdf["j"].iat[0], []
        for x in range(len(pdf) - 1):
            y = slice(x + 1, None)
            ok = (home[y] != home[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))
            if crossing:
                ok &= mine[y] != mine[x]
            at = np.nonzero(ok)[0] + x + 1
            if len(at):
                at = at[(sign[at] == sign[x]).mean(1) >= share]
                out += [(rep[x], rep[z]) for z in at]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return own.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, share: float = SIGN_SHARE, block: int = BLOCK,
                    block_bytes: int = BLOCK_BYTES, near_share: float = NEAR_SHARE) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable), kept, and the MD5 of its text."""
    path = workspace(df.sparkSession, "near-dedup")
    docs = id_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    rows = saved(sketches(docs, words), f"{path}/sketches")
    some = rows.where("n > 0 and id is not null")
    # equal sets have equal sketches; combined map-side, so a large group of copies is no hot spot
    reps = some.groupBy("set_key").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("halves").alias("halves"), F.first("sign").alias("sign")
    )
    reps = saved(reps, f"{path}/reps")
    members = _bucket_members(reps, path, HALVES)
    signs = reps.select("rep", "n", "sign")

    star = members.where("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    left = signs.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sign").alias("sign_a"))
    right = signs.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sign").alias("sign_b"))
    known = docs.where("id is not null")
    pairs = saved(_agreeing(star.join(left, "a").join(right, "b"), min(share, near_share)), f"{path}/agreeing")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    alike = pairs.where(fits & (F.col("agree") >= share)).select("a", "b").distinct()
    links = _confirmed(alike, known, words, percent, f"{path}/star")
    comps = connected(links, f"{path}/components-1")
    near = connected(pairs.select("a", "b"), f"{path}/neighbourhoods")
    joins = saved(_inside(near, comps, reps, known, words, percent, share, block_bytes), f"{path}/joins")
    more = _confirmed(_across(members, near, reps, percent, share, block), known, words, percent, f"{path}/across")
    comps = connected(links.unionByName(joins).unionByName(more), f"{path}/components-2")

    classes = reps.select("set_key", "rep").join(comps, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("root", "rep").alias("root")
    )
    found = rows.join(classes, "set_key", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"), "text_md5",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept, "text_md5")


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_md5) of the rows that go if one of each group of near duplicates stays, each row judged by
    its own text: of an id with several texts, all but one take part under ids of their own beyond all others."""
    path = workspace(df.sparkSession, "near-copies")
    docs = id_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long")).where("id is not null")
    marked = docs.select("id", F.md5("text").alias("md5")).where("md5 is not null")
    several = marked.groupBy("id").agg(F.min("md5").alias("first"), F.max("md5").alias("last")).where("first < last")
    more = saved(marked.join(several.select("id", "first"), "id").where("md5 > first").select("id", "md5").distinct(), f"{path}/more")
    if more.isEmpty():
        return near_duplicates(docs, "id").where("not kept").select("doc_id", "text_md5")
    top = docs.agg(F.max("id")).first()[0]
    # numbered by place in the written table, so that every reader sees the same numbers
    own = more.withColumn("own", F.monotonically_increasing_id() + F.lit(top + 1)).select(F.col("id").alias("was"), F.col("md5").alias("_md5"), "own")
    own = saved(own, f"{path}/own")
    named = docs.join(own, (F.col("id") == F.col("was")) & (F.md5("text") == F.col("_md5")), "left")
    found = near_duplicates(named.select(F.coalesce("own", "id").alias("id"), "text"), "id").where("not kept")
    return found.join(own, F.col("doc_id") == F.col("own"), "left").select(F.coalesce("was", "doc_id").alias("doc_id"), "text_md5")
