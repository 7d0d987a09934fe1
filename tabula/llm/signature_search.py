"""Ranked lexical search over bit-sliced Bloom signatures, exact for every document.

Documents are taken in blocks. In a block each document has a Bloom signature of its terms,
and the signatures are stored bit-sliced: one bitmap over the block's documents per bit of
the signature. The bitmaps of a term's ``PROBES`` bits, joined by AND, mark every document
that holds the term, and a few that do not: presence is overestimated, never missed. Two
more terms are entered for a term that occurs at least 2 and at least 4 times, so a bitmap
exists for each of the three steps.

A term that a document holds t times adds weight * factor(t), and the factor grows with t.
So the weighted sum

    weight * (factor(1) * held + (factor(3) - factor(1)) * twice + (factor(most) - factor(3)) * four times)

over a query's terms, where ``most`` is the largest count of any term in the document, is an
upper bound of the document's score. A task keeps the best ``top`` documents of each query so
far; a document is left out only if its bound is below the worst of them (or equal, with a
larger id), so no document of the result can be missed. All others are scored exactly, from
their whole text. Tasks return at most ``top`` rows per query, which are merged in two steps.

Statistics (documents, terms, document frequencies) are counted over all documents first.
Queries are taken in blocks of ``QUERIES``, so what tasks receive is bounded, whatever their
number.

Each row is a document, so repeated rows are ranked separately; documents without id come
after the others of equal score. Null, empty or blank texts hold no terms and are never
returned; an item without terms, or whose terms occur nowhere, returns nothing. Repeated
items (equal id and text) are answered once; items that share an id but not the text have a
ranking each.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.common import id_text, saved, slices, workspace

TOP = 10
QUERIES = 1000
#: Bits of a signature per entry of its block's largest document, and bits set per entry.
BITS = 10
PROBES = 4
#: Cells (bits times documents) of a block at most, if it has more than one document.
CELLS = 1 << 25
BLOCK = 512
#: Tasks whose rows meet in one step of the merge.
MERGE = 256
_U = np.uint64
_TWICE, _FOUR = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
#: Bytes of the term characters: ASCII letters and digits, and all of other characters; A-Z as a-z.
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms(text: bytes | str | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_TERM_BYTES).split()


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def factor(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n, n_docs: int, total: int):
    return 100 - 90 + (90 * n * n_docs) // total


def _hashes(words) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(entries, PROBES) positions in a signature."""
    first, step = _mixed(hashes), _mixed(hashes ^ _U(0x5851F42D4C957F2D)) | _U(1)
    return ((first[:, None] + np.arange(PROBES, dtype=_U) * step[:, None]) % _U(bits)).astype(np.int64)


def entries(counts: Counter) -> np.ndarray:
    """Hashes of a document's terms, and of the marks of those that occur twice and four times."""
    own = _hashes(counts)
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    return np.concatenate([own, own[tf >= 2] ^ _TWICE, own[tf >= 4] ^ _FOUR])


def sliced(signed: list[np.ndarray], bits: int) -> np.ndarray:
    """Bit-sliced signatures: row b has a bit per document, whether its signature sets bit b."""
    cells = np.zeros((bits, len(signed)), np.bool_)
    for d, own in enumerate(signed):
        cells[probes(own, bits).ravel(), d] = True
    return np.packbits(cells, axis=1)


def marked(slices_: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """(entries, documents) of 0 and 1: whether all bits of an entry are set."""
    both = np.bitwise_and.reduce(slices_[probes(hashes, len(slices_))], axis=1)
    return np.unpackbits(both, axis=1, count=n)


def blocks(documents: list[tuple]) -> list[list[tuple]]:
    """Documents (id, counts, entries) of similar sizes together, so that signatures fit them."""
    out: list[list[tuple]] = []
    for doc in sorted(documents, key=lambda d: len(d[2])):
        if out and len(out[-1]) < BLOCK and (len(out[-1]) + 1) * len(doc[2]) * BITS <= CELLS:
            out[-1].append(doc)
        else:
            out.append([doc])
    return out


def _order(doc_id) -> tuple:
    return (doc_id is None, doc_id)


class Searcher:
    """The best documents of each query over the blocks seen so far."""

    def __init__(self, queries: list[list[bytes]], weights: dict[bytes, int], n_docs: int, total: int, top: int):
        self.vocabulary = sorted({t for q in queries for t in q if weights.get(t)})
        place = {t: i for i, t in enumerate(self.vocabulary)}
        self.hashes = _hashes(self.vocabulary)
        self.queries = [[(t, weights[t]) for t in q if t in place] for q in queries]
        self.rows = [np.array([place[t] for t, _ in q], np.int64) for q in self.queries]
        self.weights = [np.array([w for _, w in q], np.float64) for q in self.queries]
        self.n_docs, self.total, self.top = n_docs, total, top
        self.best: list[list[tuple]] = [[] for _ in queries]
        self.scored = self.bounded = 0

    def bounds(self, block: list[tuple]) -> np.ndarray:
        """(queries, documents): no score is larger. Whole numbers under 2**53, so doubles hold them."""
        n = len(block)
        slices_ = sliced([d[2] for d in block], max(64, BITS * max(len(d[2]) for d in block)))
        held = marked(slices_, self.hashes, n)
        twice = marked(slices_, self.hashes ^ _TWICE, n) & held
        four = (marked(slices_, self.hashes ^ _FOUR, n) & twice).astype(float)
        m = length_norm(np.array([d[1].total() for d in block], np.int64), self.n_docs, self.total)
        most = np.array([max(d[1].values()) for d in block], np.int64)
        one, three, all_ = factor(1, m), factor(np.minimum(most, 3), m), factor(most, m)
        held, twice = held.astype(float), twice.astype(float)
        out = np.zeros((len(self.queries), n))
        for q, (rows, weights) in enumerate(zip(self.rows, self.weights, strict=True)):
            if len(rows):
                out[q] = (weights @ held[rows]) * one + (weights @ twice[rows]) * (three - one) + (weights @ four[rows]) * (all_ - three)
        return out

    def score(self, q: int, counts: Counter) -> int:
        m = length_norm(counts.total(), self.n_docs, self.total)
        return sum(w * factor(counts[t], m) for t, w in self.queries[q] if t in counts)

    def add(self, block: list[tuple]) -> None:
        bounds = self.bounds(block)
        self.bounded += bounds.size
        for q in range(len(self.queries)):
            best, own = self.best[q], bounds[q]
            able = np.flatnonzero(own >= (max(1, -best[-1][0]) if len(best) == self.top else 1))
            # from the largest bound down, so that the threshold rises as early as it can
            for d in able[np.argsort(-own[able], kind="stable")]:
                worst = best[-1] if len(best) == self.top else None
                if worst and own[d] < -worst[0]:
                    break
                doc_id, counts = block[d][:2]
                if worst and own[d] == -worst[0] and _order(doc_id) > worst[1]:
                    continue
                self.scored += 1
                if score := self.score(q, counts):
                    best.append((-score, _order(doc_id), doc_id))
                    best.sort()
                    del best[self.top :]


def _statistics(vocabulary: frozenset):
    def run(batches):
        found, n_docs, total = Counter(), 0, 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    own = terms(text)
                    if own:
                        n_docs, total = n_docs + 1, total + len(own)
                        found.update(vocabulary.intersection(own))
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array([None, b"", *found], pa.binary()),
                "n": pa.array([n_docs, total, *found.values()], pa.int64()),
            }
        )

    return run


def statistics(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """(documents with a term, all their terms, documents holding each term of ``vocabulary``)."""
    parts = docs.select("text").mapInArrow(_statistics(frozenset(vocabulary)), "term binary, n long")
    rows = {None if r.term is None else bytes(r.term): r.n for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return rows.pop(None, 0), rows.pop(b"", 0), rows


def _ranked(queries, numbers, weights, n_docs, total, top):
    def run(batches):
        from pyspark import TaskContext

        searcher = Searcher(queries, weights, n_docs, total, top)
        for batch in batches:
            for part in slices(batch, BLOCK):
                counted = []
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    counts = Counter(terms(text))
                    if counts:
                        counted.append((doc_id, counts, entries(counts)))
                for block in blocks(counted):
                    searcher.add(block)
        found = [(numbers[q], doc_id, -score) for q, best in enumerate(searcher.best) for score, _, doc_id in best]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_pydict(
            {
                "q": pa.array(columns[0], pa.int64()),
                "doc_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.int64()),
                "part": pa.array([TaskContext.get().partitionId() // MERGE] * len(found), pa.int64()),
            }
        )

    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` highest-scoring documents."""
    spark, path = docs.sparkSession, workspace(docs.sparkSession, "search")
    own = id_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).distinct()
    asked = saved(asked.withColumn("q", F.monotonically_increasing_id()), f"{path}/queries")
    parts = -(-asked.count() // QUERIES)
    found = spark.createDataFrame([], "q long, doc_id long, score long, part long")
    for k in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == k).collect()
        queries = [sorted(set(terms(r.text))) for r in rows]
        n_docs, total, frequency = statistics(own, {t for q in queries for t in q})
        if total:
            weights = {t: weight(n_docs, f) for t, f in frequency.items()}
            ranked = _ranked(queries, [r.q for r in rows], weights, n_docs, total, top)
            found = found.unionByName(saved(own.mapInArrow(ranked, found.schema), f"{path}/found-{k}"))
    for keys in (["q", "part"], ["q"]):  # the rows of MERGE tasks first, so that no task ever holds those of all
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found.join(asked.select("q", "item_id"), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
