"""Token ids as shards of separately compressed documents with a shared dictionary.

Format (a folder written and read by Spark, so it may lie in any store):

* ``dictionary/``: one row (dict_hash, dictionary): a zstandard dictionary trained on the
  serialized id arrays of a bounded sample; ``dict_hash`` is its SHA-256.
* ``shards/``: one row per shard, shards in ascending id order. ``payload`` is the
  concatenation of one zstandard frame per document, whose content is the ids as
  little-endian unsigned integers of ``width`` bytes. The index of a shard is
  ``doc_ids``, ``offsets`` (of the frames; one more than documents) and ``counts`` (ids per
  document). ``dict_hash`` names the dictionary, ``shard_key`` the shard.

A document is read alone by its shard's index, its frame and the dictionary.

Rows are ordered by (id, text), null ids first; null and empty texts have only the end id.
Repeated ids are separate documents. An empty table gives no shard.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import accumulate, chain, compress, count, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.llm.common import id_text, slices, small_side

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Documents whose serialized ids train the dictionary: those of the smallest id hash.
TRAIN_DOCS = 1_000
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 32 << 10
LEVEL = 3
#: A shard closes at this many payload bytes or documents.
SHARD_BYTES = 8 << 20
SHARD_DOCS = 4_096
#: Words of one generation that a task remembers.
MEMORY = 1_000_000
SHARD_SCHEMA = (
    "shard_key string, first_id long, last_id long, n_docs int, n_ids long, dict_hash string, width int, "
    "doc_ids array<bigint>, offsets array<int>, counts array<int>, payload binary"
)


def _byte_level() -> dict[int, str]:
    """The byte-level pre-tokenizer's text for the lower case of every letter in ``_LETTERS``: printable bytes stand
    for themselves, the others for characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    of = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}
    return {ord(c): "".join(of[b] for b in c.lower().encode()) for c in _LETTERS}


#: Letters below U+0250 whose lower case is one letter below it as well.
_LETTERS = "".join(
    c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and c.lower().isalpha() and c.lower() < "\u0250"
)
#: A word of such letters, and what ends it: ASCII marks but the apostrophe, which begins contractions.
_SIMPLE = re.compile(rf"([{_LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    The vocabulary's normalizer and pre-tokenizer never join characters across a space, a
    tab or a line break, so a text's ids are those of its words in turn. The vocabulary's special tokens
    hold no space either, so a word with one is split there by the library, as in a whole text. Letters and
    a run of marks behind them are a pre-token each. A word of letters below U+0250 is only lower-cased by the
    normalizer, so it goes to the model directly.

    Words are remembered in two generations of ``MEMORY`` words: when the young one is full it
    becomes the old one, and what is met again moves to the young one.
    """

    def __init__(self, path: str, width: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = width
        self.packed = [i.to_bytes(width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.bytes_of = _byte_level()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join([self.packed[i] for i in ids])

    def _learn(self, words: set[str]) -> None:
        young, old, marks, table = self.young, self.old, self.marks, self.bytes_of
        plain = [w for w in words if w.isascii() and w.isalpha()]
        rest, ended, cores = [], [], set()
        for word in words.difference(plain):
            found = _SIMPLE.fullmatch(word)
            if found is None:
                rest.append(word)
                continue
            core, end = found.groups()
            cores.add(core)
            if end:
                ended.append((word, core, end))
        # no set operations with the views of the memories: these walk all that is remembered
        young.update([(c, old[c]) for c in cores if c in old and c not in young])
        cores = [c for c in cores if c not in young]
        texts = [c.lower() if c.isascii() else c.translate(table) for c in cores]
        made = list(map(self.tokenizer.model.tokenize, chain(map(str.lower, plain), texts)))
        flat = np.array([t.id for tokens in made for t in tokens], f"<u{self.width}").tobytes()
        ends = [self.width * n for n in accumulate(map(len, made), initial=0)]
        young.update(zip(chain(plain, cores), [flat[a:b] for a, b in zip(ends, ends[1:])]))
        for start in range(0, len(rest), 8192):
            some = rest[start : start + 8192]
            made = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            young.update((w, self._pack(e.ids)) for w, e in zip(some, made))
        if len(marks) > MEMORY:
            marks.clear()
        for end in {e for *_, e in ended if e not in marks}:
            marks[end] = self._pack(self.tokenizer.encode(end, add_special_tokens=False).ids)
        young.update([(word, young[core] + marks[end]) for word, core, end in ended])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The serialized ids of each text."""
        if len(self.young) > MEMORY:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        split = [_spaced(t).split(" ") if t else [] for t in texts]
        made = [list(map(young.get, words)) for words in split]
        # the places of words that are not known yet; only these are looked up again
        gaps = [(i, list(compress(count(), map(is_, parts, repeat(None))))) for i, parts in enumerate(made) if None in parts]
        fresh = {split[i][k] for i, places in gaps for k in places}
        met = {w for w in fresh if w in old}
        young.update([(w, old[w]) for w in met])
        self._learn(fresh - met)
        for i, places in gaps:
            words, parts = split[i], made[i]
            for k in places:
                parts[k] = young[words[k]]
        return [b"".join(parts) for parts in made]


def _spaced(text: str) -> str:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


@lru_cache(maxsize=2)
def encoder(path: str, width: int = 2) -> WordEncoder:
    return WordEncoder(path, width)


def id_width(path: str, end_id: int) -> int:
    """Bytes per serialized id."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def _dictionary(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _compressor(dictionary: bytes):
    """A compressor that digests the dictionary once, not for every document."""
    import zstandard

    data = _dictionary(dictionary)
    if data is None:
        return zstandard.ZstdCompressor(level=LEVEL)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data)


def train_dictionary(df: DataFrame, path: str, width: int, end_id: int = END_ID, train_docs: int = TRAIN_DOCS,
                     dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Dictionary from at most ``train_docs`` documents (``id``, ``text``), chosen by the hash of
    their id, and at most ``sample_bytes`` of each. Samples too small to train on give their concatenation as a raw dictionary."""
    import zstandard

    picked = df.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(train_docs).select("id").distinct()
    sample = df.join(F.broadcast(picked), "id", "left_semi").select(F.xxhash64("id").alias("h"), "text")

    def encode(batches):
        for batch in batches:
            for part in slices(batch):
                made = encoder(path, width).encode(part.column(1).to_pylist())
                blobs = [(ids + end_id.to_bytes(width, "little"))[:sample_bytes] for ids in made]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(blobs, pa.binary())], ["h", "ids"])

    rows = sample.mapInArrow(encode, "h long, ids binary").orderBy("h", "ids").limit(train_docs).collect()
    blobs = [bytes(r.ids) for r in rows]
    try:
        return zstandard.train_dictionary(dict_bytes, blobs).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blobs)[:dict_bytes]


def write_shards(df: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                 end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> None:
    """Write ``df`` to the folder ``out`` in the format above."""
    spark = df.sparkSession
    docs = id_text(df, id_col, text_col)
    width = id_width(path, end_id)
    dictionary = train_dictionary(docs, path, width, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{out}/dictionary")

    def shard(ids, counts, frames, seq):
        offsets = np.cumsum([0, *map(len, frames)])
        row = {
            "shard_key": f"{ids[0]}:{seq}", "first_id": ids[0], "last_id": ids[-1], "n_docs": len(ids),
            "n_ids": sum(counts), "dict_hash": dict_hash, "width": width, "doc_ids": ids,
            "offsets": offsets.tolist(), "counts": counts, "payload": b"".join(frames),
        }
        return pa.RecordBatch.from_pylist([row], schema=_ARROW)

    def pack(batches):
        press = _compressor(dictionary)
        own, end = encoder(path, width), end_id.to_bytes(width, "little")
        ids, counts, frames, size, seq = [], [], [], 0, 0
        for batch in batches:
            for part in slices(batch):
                made = own.encode(part.column(1).to_pylist())
                for doc_id, tokens in zip(part.column(0).to_pylist(), made):
                    frame = press.compress(tokens + end)
                    if frames and (size + len(frame) > shard_bytes or len(frames) >= shard_docs):
                        yield shard(ids, counts, frames, seq)
                        ids, counts, frames, size, seq = [], [], [], 0, seq + 1
                    ids.append(doc_id)
                    counts.append(len(tokens) // width + 1)
                    frames.append(frame)
                    size += len(frame)
        if frames:
            yield shard(ids, counts, frames, seq)

    # the texts are dealt by ranges of the id before they are encoded: the boundaries' sampling
    # pass then reads columns only, and each range becomes shards in one narrow step
    ranged = docs.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    ranged.mapInArrow(pack, SHARD_SCHEMA).write.mode("overwrite").option("compression", "none").parquet(f"{out}/shards")


_ARROW = pa.schema([
    ("shard_key", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int32()),
    ("n_ids", pa.int64()), ("dict_hash", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("payload", pa.binary()),
])


def _shards(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(f"{out}/shards")


def _dictionaries(spark: SparkSession, out: str) -> dict[str, bytes]:
    """By hash; a written folder has one, a folder merged from several has theirs."""
    rows = spark.read.schema("dict_hash string, dictionary binary").parquet(f"{out}/dictionary").collect()
    found = {r.dict_hash: bytes(r.dictionary) for r in rows}
    for name, data in found.items():
        if hashlib.sha256(data).hexdigest() != name:
            raise ValueError(f"dictionary {name} is damaged")
    return found


def _unpacked(shards: DataFrame, dictionaries: dict[str, bytes], schema: str, make) -> DataFrame:
    """One row per document: ``make(ids)`` gives its values after (shard_key, doc_id, local_start)."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    head = "shard_key string, doc_id long, local_start long"
    kind = _parse_datatype_string(f"{head}, {schema}")
    arrow = to_arrow_schema(kind)

    def run(batches):
        import zstandard

        open_ = {}
        for batch in batches:
            for part in slices(batch, 1):
                s = part.to_pylist()[0]
                if s["dict_hash"] not in open_:
                    data = _dictionary(dictionaries[s["dict_hash"]])
                    open_[s["dict_hash"]] = zstandard.ZstdDecompressor(dict_data=data)
                press, payload, rows, start = open_[s["dict_hash"]], memoryview(s["payload"]), [], 0
                for i, doc_id in enumerate(s["doc_ids"]):
                    a, b = s["offsets"][i], s["offsets"][i + 1]
                    ids = np.frombuffer(press.decompress(payload[a:b]), f"<u{s['width']}")
                    if len(ids) != s["counts"][i]:
                        raise ValueError(f"shard {s['shard_key']}: document {i} has {len(ids)} ids")
                    rows.append((s["shard_key"], doc_id, start, *make(ids)))
                    start += len(ids)
                    if len(rows) >= 1024 or i + 1 == len(s["doc_ids"]):
                        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                        yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                        rows = []

    return shards.mapInArrow(run, kind)


def _starts(spark: SparkSession, out: str) -> DataFrame:
    """(shard_key, base): ids of all shards before. Reads the small columns; one row per shard."""
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), F.split("shard_key", ":")[1].cast("int"))
    before = F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return _shards(spark, out).select("shard_key", F.coalesce(before, F.lit(0)).alias("base"))


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids and the count of ids before it."""
    docs = _unpacked(_shards(spark, out), _dictionaries(spark, out), "ids array<bigint>", lambda ids: (ids.tolist(),))
    joined = docs.join(small_side(_starts(spark, out), 64), "shard_key")
    return joined.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "ids")


def lookup(spark: SparkSession, out: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: shards are pruned by their id range, and only the asked
    frames are cut out of the payload and decompressed."""
    asked = sorted({int(x) for x in doc_ids})
    if not asked:
        return read_shards(spark, out).select("doc_id", "ids").limit(0)
    hit = _shards(spark, out).where(F.coalesce(F.col("first_id") <= asked[-1], F.lit(True))).where(F.col("last_id") >= asked[0])
    frames = (
        hit.select("*", F.posexplode("doc_ids").alias("_i", "_id"))
        .where(F.col("_id").isin(asked))
        .select(
            "shard_key", "first_id", "last_id", F.lit(1).alias("n_docs"), F.lit(0).cast("long").alias("n_ids"),
            "dict_hash", "width", F.array("_id").alias("doc_ids"),
            F.array(F.lit(0), F.expr("offsets[_i + 1] - offsets[_i]")).alias("offsets"),
            F.array(F.expr("counts[_i]")).alias("counts"),
            F.expr("substring(payload, offsets[_i] + 1, offsets[_i + 1] - offsets[_i])").alias("payload"),
        )
    )
    made = _unpacked(frames, _dictionaries(spark, out), "ids array<bigint>", lambda ids: (ids.tolist(),))
    return made.select("doc_id", "ids")


def digests(spark: SparkSession, out: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    docs = _unpacked(
        _shards(spark, out), _dictionaries(spark, out), "n_tokens long, ids_crc32 long",
        lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
    )
    joined = docs.join(small_side(_starts(spark, out), 64), "shard_key")
    return joined.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
