"""Removal of repeated passages, located by sharded Aho-Corasick automata over words.

A window is ``WINDOW`` consecutive words of a document. A word goes if a window covers it
whose words also start somewhere in a document with a smaller id.

1. Documents are dealt by a hash of their content to blocks of about ``BLOCK_BYTES`` and written
   once as a table bucketed by block, so that none of the later steps moves a text again.
2. Confirming which passages recur: of every window the ``GRAM``-word gram of the smallest hash is
   kept (winnowing: equal windows keep equal grams). Windows that hold a gram of two or more
   documents are hashed whole (96 bits), once per block, and every recurring window learns its
   leader: the smallest id that holds it, and where it starts there.
3. A document is cut into cells of ``CELL`` window starts. The cells that hold a leader's window
   are the recurring passages: ``CELL + WINDOW - 1`` words each, cut out of their documents once and
   sent to every block with a window in them.
4. Each block compiles the passages it received into automata of at most ``PHRASES`` phrases: the grams
   at every ``WINDOW - GRAM + 1`` words of a passage, so that no window of it is without one. All
   documents of the block are streamed through them; at every occurrence the words of document and
   passage are compared, and runs of ``WINDOW`` equal words or more are removed if the passage's
   document has a smaller id. So hashes only say where to look: what is removed was compared word
   by word.

A block's automata hold only passages that its own documents contain, so the work grows with the
corpus, not with its square, and a passage that a third of all documents share costs a block one copy.

Words are maximal runs of other characters than 09-0D and 20. Null, empty and blank texts
have no words. A document without id loses nothing and takes nothing from others; rows that repeat
an id are no reason for each other's removal, but both lose what a smaller id holds. Rows equal in id
and text land in one block. Kept words are joined by one space.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.common import id_text, saved, slices, workspace

WINDOW = 50
GRAM = 25
CELL = 64
BLOCK_BYTES = 8 << 20
#: Buckets of the table of blocks; beyond it a bucket holds several blocks.
BUCKETS = 20_000
#: Phrases of one automaton; a block with more streams its documents once per automaton.
PHRASES = 20_000
#: Digits of word numbers in an automaton.
BASE = 32
_U = np.uint64
OUT = "doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept_text string"


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, _U(b))])) for b in (base, inverse))


def rolling(hashes: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of every ``size`` consecutive hashes, mixed so that all bits depend on all."""
    if len(hashes) < size:
        return hashes[:0]
    power, inverse = _powers(base, 1 << max(16, int(len(hashes)).bit_length()))
    total = np.concatenate([[_U(0)], np.cumsum(hashes * power[: len(hashes)], dtype=_U)])
    x = (total[size:] - total[:-size]) * inverse[: len(total) - size]
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sliding(values: np.ndarray, span: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``span`` consecutive values, in logarithmic steps."""
    size = 1
    while size * 2 <= span:
        values, size = pick(values[:-size], values[size:]), size * 2
    return pick(values[: len(values) - (span - size)], values[span - size :]) if span > size else values


def winnowed(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest gram of every ``span`` consecutive ones; of equal grams all."""
    if len(grams) < span:
        return np.zeros(0, np.int64)
    least = _sliding(grams, span, np.minimum)
    # a gram is kept if it is the smallest of some window that it is in; outside of the text there is none
    around = np.concatenate([np.zeros(span - 1, _U), least, np.zeros(span - 1, _U)])
    return np.flatnonzero(grams <= _sliding(around, span, np.maximum))


def grams_of(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept grams, their positions) of a document."""
    all_ = rolling(hashes, gram)
    at = winnowed(all_, window - gram + 1)
    return all_[at], at


def _documents(table: pa.Table) -> Iterator[tuple[int, list[bytes]]]:
    """(id, words) of a block's documents, one at a time."""
    for batch in table.select(["id", "text"]).to_batches():
        for part in slices(batch):
            for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                yield doc_id, text.split()


def _fingerprints(window: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        found, ids = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
        for doc_id, words in _documents(table):
            if len(words) >= window:
                own = np.unique(grams_of(word_hashes(words), window, gram)[0])
                found.append(own)
                ids.append(np.full(len(own), doc_id))
        fp, doc = np.concatenate(found), np.concatenate(ids)
        order = np.lexsort((doc, fp))
        fp, doc = fp[order], doc[order]
        first = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]][: len(fp)])
        last = np.r_[first[1:] - 1, len(fp) - 1][: len(first)]
        block = table.column("b")[0].as_py()
        return pa.table(
            {
                "fp": fp[first].view(np.int64),
                "b": np.full(len(first), block, np.int32),
                "lo": doc[first],
                "hi": doc[last],
            }
        )

    return run


def _windows(window: int, gram: int):
    def run(table: pa.Table, marks: pa.Table) -> pa.Table:
        known = np.sort(marks.column("fp").to_numpy().view(_U))
        parts = [(np.zeros(0, _U), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for doc_id, words in _documents(table) if len(known) else ():
            if len(words) < window:
                continue
            hashes = word_hashes(words)
            grams, at = grams_of(hashes, window, gram)
            near = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            at = at[known[near] == grams]
            if not len(at):
                continue
            size = len(words) - window + 1
            step = np.zeros(size + 1, np.int64)  # the windows around each recurring gram
            np.add.at(step, np.maximum(at - (window - gram), 0), 1)
            np.add.at(step, np.minimum(at + 1, size), -1)
            start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            second = (rolling(hashes, window, 0xD1342543DE82EF95)[start] >> _U(32)).astype(np.uint32)
            parts.append((rolling(hashes, window)[start], second, np.full(len(start), doc_id), start))
        h, g, doc, start = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((start, doc, g, h))
        h, g, doc, start = h[order], g[order], doc[order], start[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])][: len(h)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(h) - 1][: len(first)]
        block = table.column("b")[0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "h": h[first].view(np.int64),
                "g": g[first].view(np.int32),
                "lo": doc[first],
                "place": (np.int64(block) << np.int64(32)) | start[first],
                "hi": doc[last],
            }
        )

    return run


def _cut(window: int, cell: int):
    def run(table: pa.Table, wanted: pa.Table) -> pa.Table:
        cells: dict[int, list[int]] = {}
        for doc_id, c in zip(wanted.column("lo").to_pylist(), wanted.column("cell").to_pylist(), strict=True):
            cells.setdefault(doc_id, []).append(c)
        out = []
        for doc_id, words in _documents(table) if cells else ():
            for c in cells.get(doc_id, ()):
                own = words[c * cell : (c + 1) * cell + window - 1]
                if len(own) >= window:
                    out.append((doc_id, c, b" ".join(own)))
        ids, numbers, texts = zip(*out, strict=True) if out else ((), (), ())
        block = table.column("b")[0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "lb": pa.array([block] * len(ids), pa.int32()),
                "lo": pa.array(ids, pa.int64()),
                "cell": pa.array(numbers, pa.int64()),
                "passage": pa.array(texts, pa.binary()),
            }
        )

    return run


class Passages:
    """Passages as rows of word numbers, and automata that find where a document holds one.

    An automaton's node looks its next symbol up among all that it has, and thousands of phrases begin
    with different words. So a word goes in as the digits of its number, in an alphabet of its own for each
    place of a digit: nodes have ``BASE`` symbols at most, and no match can begin within a word.
    """

    def __init__(self, rows: Iterable[tuple[int, bytes]], window: int = WINDOW, gram: int = GRAM, phrases: int = PHRASES):
        smallest: dict[bytes, int] = {}
        for doc_id, text in rows:
            smallest[text] = min(doc_id, smallest.get(text, doc_id))
        self.window, self.gram, self.numbers = window, gram, {}
        self.owner, self.words = list(smallest.values()), []
        places: dict[tuple, list[tuple[int, int]]] = {}
        for k, text in enumerate(smallest):
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split()]
            self.words.append(np.array(own, np.int64))
            for at in range(0, len(own) - gram + 1, window - gram + 1):
                places.setdefault(tuple(own[at : at + gram]), []).append((k, at))
        keys = list(places)
        self.shards = [{key: places[key] for key in keys[i : i + phrases]} for i in range(0, len(keys), phrases)]
        self.digits = 1
        while BASE**self.digits <= len(self.numbers):
            self.digits += 1
        # number 0 stands for all words that no passage has; its symbol is in no alphabet
        self.codes = ["\0" * self.digits, *map(self._code, range(1, len(self.numbers) + 1))]

    def _code(self, number: int) -> str:
        return "".join(chr(1 + BASE * i + number // BASE**i % BASE) for i in range(self.digits))

    def automata(self):
        """One compiled automaton at a time, so that a block never holds two."""
        import ahocorasick

        for shard in self.shards:
            found = ahocorasick.Automaton(ahocorasick.STORE_ANY)
            for key, where in shard.items():
                found.add_word("".join([self.codes[n] for n in key]), where)
            found.make_automaton()
            yield found

    def numbered(self, words: list[bytes]) -> list[int]:
        return list(map(self.numbers.get, words, repeat(0)))

    def mark(self, automaton, doc_id: int, own: list[int], gone: np.ndarray) -> None:
        """Set ``gone`` at the words that a passage of a smaller id covers by a whole window."""
        codes, found = self.codes, {}
        for end, where in automaton.iter("".join(map(codes.__getitem__, own))):
            last = end // self.digits
            for k, at in where:
                if self.owner[k] < doc_id:
                    found[k, last - self.gram + 1 - at] = None
        if not found:
            return
        array, hits = np.array(own), list(found)
        # some from all over the text first: in one that repeats itself, they leave little to compare for the rest
        for k, shift in hits[:: self.window] + hits:
            passage = self.words[k]
            low, high = max(0, shift), min(len(own), shift + len(passage))
            if high - low < self.window or gone[low:high].all():
                continue
            same = np.concatenate([[0], np.cumsum(array[low:high] == passage[low - shift : high - shift])])
            whole = np.flatnonzero(same[self.window :] - same[: -self.window] == self.window)
            if len(whole):
                cuts = np.flatnonzero(np.diff(whole) > 1)
                for a, z in zip(whole[[0, *(cuts + 1)]], whole[[*cuts, -1]], strict=True):
                    gone[low + a : low + z + self.window] = True


def spans(gone: np.ndarray) -> list[dict]:
    """Runs of set places, end exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    return [{"start": int(a), "end": int(z)} for a, z in zip(edge[::2], edge[1::2], strict=True)]


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept_text", pa.string()),
    ]
)


def _result(doc_id, words: list[bytes], gone: np.ndarray | None) -> tuple:
    if gone is None or not gone.any():
        return doc_id, len(words), 0, [], b" ".join(words).decode()
    kept = [words[i] for i in np.flatnonzero(~gone)]
    return doc_id, len(words), len(words) - len(kept), spans(gone), b" ".join(kept).decode()


def _columns(rows: list[tuple]) -> dict:
    own = zip(*rows, strict=True) if rows else ((),) * len(_SCHEMA)
    return {f.name: pa.array(list(c), f.type) for f, c in zip(_SCHEMA, own, strict=True)}


def _stream(window: int, gram: int, phrases: int):
    def run(table: pa.Table, sent: pa.Table) -> pa.Table:
        passages = Passages(zip(sent.column("lo").to_pylist(), sent.column("passage").to_pylist(), strict=True), window, gram, phrases)
        gone: dict[int, np.ndarray] = {}
        rows, last = [], max(0, len(passages.shards) - 1)
        for turn, automaton in enumerate(passages.automata() if passages.shards else [None]):
            for n, (doc_id, words) in enumerate(_documents(table)):
                if automaton is not None and len(words) >= window:
                    marks = gone.setdefault(n, np.zeros(len(words), bool))
                    passages.mark(automaton, doc_id, passages.numbered(words), marks)
                if turn == last:
                    rows.append(_result(doc_id, words, gone.pop(n, None)))
        return pa.table(_columns(rows), schema=_SCHEMA)

    return run


def _untouched(batches):
    for batch in batches:
        for part in slices(batch):
            texts = part.column("text").to_pylist()
            rows = [_result(d, (t or b"").split(), None) for d, t in zip(part.column("id").to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_pydict(_columns(rows), schema=_SCHEMA)


def _blocked(rows: DataFrame, path: str, block_bytes: int) -> DataFrame:
    """(b, id, text) as a table bucketed by block: later groupings by b need no shuffle of it."""
    size = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets, name = min(blocks, BUCKETS), f"repeated_passages_{uuid.uuid4().hex}"
    dealt = rows.withColumn("b", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")).repartition(buckets, "b")
    writer = dealt.write.format("parquet").option("compression", "zstd").option("path", f"{path}/blocks")
    writer.bucketBy(buckets, "b").sortBy("b").saveAsTable(name)
    table = rows.sparkSession.table(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows their buckets
    return table


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
    cell: int = CELL, block_bytes: int = BLOCK_BYTES, phrases: int = PHRASES,
) -> DataFrame:
    """Per document: its words, how many go, their spans (word places, end exclusive) and the text that is kept."""
    path = workspace(docs.sparkSession, "repeats")
    own = id_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    able = F.coalesce(F.col("id").isNotNull() & (F.octet_length("text") >= 2 * window - 1), F.lit(False))
    table = _blocked(own.where(able), path, block_bytes)

    fps = table.groupBy("b").applyInArrow(_fingerprints(window, gram), "fp long, b int, lo long, hi long")
    each = Window.partitionBy("fp")
    shared = fps.select("fp", "b", F.min("lo").over(each).alias("low"), F.max("hi").over(each).alias("high"))
    marks = shared.where("low < high").select(F.col("b").alias("mb"), "fp")

    pairs = table.groupBy("b").cogroup(marks.groupBy("mb"))
    windows = pairs.applyInArrow(_windows(window, gram), "h long, g int, lo long, place long, hi long")
    # one row per window and block: the first of a window is its leader
    same = Window.partitionBy("h", "g").orderBy("lo", "place")
    led = windows.select("place", "hi", F.first("lo").over(same).alias("lo"), F.first("place").over(same).alias("leader")).where("hi > lo")
    block = lambda c: F.shiftright(c, 32).cast("int")
    at = F.floor(F.col("leader").bitwiseAND(F.lit((1 << 32) - 1)) / cell)
    needs = saved(led.select(block("place").alias("b"), block("leader").alias("lb"), "lo", at.alias("cell")).distinct(), f"{path}/needs")

    wanted = needs.select("lb", "lo", "cell").distinct()
    cut = table.groupBy("b").cogroup(wanted.groupBy("lb")).applyInArrow(_cut(window, cell), "lb int, lo long, cell long, passage binary")
    passages = saved(cut, f"{path}/passages")
    sent = needs.join(passages, ["lb", "lo", "cell"]).select(F.col("b").alias("sb"), "lo", "passage")
    found = table.groupBy("b").cogroup(sent.groupBy("sb")).applyInArrow(_stream(window, gram, phrases), OUT)
    return found.unionByName(own.where(~able).mapInArrow(_untouched, OUT))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and a digest of the kept text."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
