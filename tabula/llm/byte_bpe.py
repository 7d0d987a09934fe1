"""Byte-level BPE by a segment tree of pair ranks.

A pre-token is a row of byte positions. A segment tree over the positions holds at every
node the smallest (pair rank, position) below it, so its root is the leftmost pair of
minimum rank. A merge writes the pair's token at the left position, unlinks the right one
and updates the three leaves whose pair changed (the merged position, its live left
neighbour and the removed position), each in logarithmic steps. Pre-tokens of up to
``WIDE`` bytes are merged side by side, one tree per row of a numpy matrix; longer ones
alone, with the same tree in an array of whole numbers.

A pre-token that is itself in the vocabulary is one id, as in the tiktoken library. Null
is the empty text: no ids, no bytes.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructType

from tabula.llm.common import releasing, slices

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Pre-tokens of at most this many bytes share a matrix of trees.
WIDE = 64
#: Pre-tokens a task remembers; over it, and when the task ends, the memory is emptied.
MEMORY = 500_000
_NONE = np.int64(1) << 40


class Merger:
    """Ranks of one vocabulary, and the merging of pre-tokens by them."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.base = max(self.bytes_of) + 1
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, ``_NONE`` where the pair is no token or a side is missing (-1)."""
        want = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (left >= 0) & (right >= 0), self.values[at], _NONE)

    def merge_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Ids of pieces of 1 to ``width`` bytes; ``width`` is a power of two."""
        n, sizes = len(pieces), np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        at = np.arange(width)
        ids = np.full((n, width + 1), -1, np.int64)  # the last column stands for "no neighbour"
        ids[:, :width] = np.where(at < sizes[:, None], self.byte_ids[raw], -1)
        after = np.tile(np.minimum(at + 1, width), (n, 1))
        after[at + 1 >= sizes[:, None]] = width
        before = np.tile(at - 1, (n, 1))
        before = np.concatenate([before, np.zeros((n, 1), before.dtype)], axis=1)
        tree = np.full((n, 2 * width), _NONE, np.int64)
        rank = self._pair_rank(ids[:, :width], np.take_along_axis(ids, after, 1))
        tree[:, width:] = np.where(rank < _NONE, rank * width + at, _NONE)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        levels = width.bit_length() - 1
        rows = np.nonzero(tree[:, 1] < _NONE)[0]
        while len(rows):
            root = tree[rows, 1]
            pos, merged = root % width, root // width
            gone = after[rows, pos]
            follow = after[rows, gone]
            ids[rows, pos], ids[rows, gone] = merged, -1
            after[rows, pos] = follow
            before[rows, follow] = pos
            prior = before[rows, pos]
            has_prior = prior >= 0
            prior = np.where(has_prior, prior, pos)
            right_rank = self._pair_rank(merged, ids[rows, follow])
            left_rank = np.where(has_prior, self._pair_rank(ids[rows, prior], merged), right_rank)
            tree[rows, width + gone] = _NONE
            tree[rows, width + pos] = np.where(right_rank < _NONE, right_rank * width + pos, _NONE)
            tree[rows, width + prior] = np.where(left_rank < _NONE, left_rank * width + prior, _NONE)
            node = np.stack([gone, pos, prior]) + width
            for _ in range(levels):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] < _NONE]
        live = ids[:, :width] >= 0
        flat, ends = ids[:, :width][live].tolist(), np.cumsum(live.sum(1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece of any length."""
        n, base, pairs = len(piece), self.base, self.pairs
        width = 1 << max(0, (n - 1).bit_length())
        raw = self.byte_ids[np.frombuffer(piece, np.uint8)]
        # a node is rank * width + position, so the smaller number is the smaller rank, then the leftmost place
        none = int(_NONE) * width
        nodes = np.full(2 * width, none, np.int64)
        rank = self._pair_rank(raw[:-1], raw[1:])
        nodes[width : width + n - 1] = np.where(rank < _NONE, rank * width + np.arange(n - 1), none)
        level = width
        while level > 1:
            nodes[level >> 1 : level] = np.minimum(nodes[level : 2 * level : 2], nodes[level + 1 : 2 * level : 2])
            level >>= 1
        tree, ids = array("q", nodes.tobytes()), array("i", raw.astype(np.int32).tobytes())
        del nodes, raw, rank
        after, before = array("i", [*range(1, n), -1]), array("i", range(-1, n - 1))

        def leaf(i: int) -> int:
            j = after[i]
            found = pairs.get(ids[i] * base + ids[j]) if j >= 0 else None
            return none if found is None else found * width + i

        while tree[1] < none:
            merged, pos = divmod(tree[1], width)
            gone = after[pos]
            follow, prior = after[gone], before[pos]
            ids[pos], ids[gone], after[pos] = merged, -1, follow
            if follow >= 0:
                before[follow] = pos
            changed = [(gone, none), (pos, leaf(pos))]
            if prior >= 0:
                changed.append((prior, leaf(prior)))
            for i, value in changed:
                node = width + i
                tree[node] = value
                while node > 1:
                    node >>= 1
                    low = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == low:
                        break
                    tree[node] = low
        return tuple(x for x in ids if x >= 0)

    def learn(self, pieces: set[str]) -> None:
        """Merge and remember pieces not seen before, as packed ids."""

        def pack(ids):
            return np.array(ids, "<u4").tobytes()

        by_width: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            if raw in self.ranks:
                self.known[piece] = pack((self.ranks[raw],))
            elif len(raw) > WIDE:
                self.known[piece] = pack(self.merge_long(raw))
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append(piece)
        for width, own in by_width.items():
            for start in range(0, len(own), 4096):
                some = own[start : start + 4096]
                self.known.update(zip(some, map(pack, self.merge_rows([p.encode() for p in some], width))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.find(t) if t else [] for t in texts]
        fresh = set().union(*split)
        if len(self.known) + len(fresh) > MEMORY:
            self.known = {}
        self.learn(fresh - self.known.keys())
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def merger(path: str, pattern: str) -> Merger:
    return Merger(path, pattern)


def _with_columns(df: DataFrame, source: str, kinds: dict[str, DataType], convert, own) -> DataFrame:
    """``df`` plus the columns ``kinds`` = ``convert`` of column ``source``, by Arrow batches; ``own`` gives the merger."""
    schema = StructType([f for f in df.schema.fields if f.name not in kinds])
    names = schema.fieldNames()
    for name, kind in kinds.items():
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                made = convert(part.column(source))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + made, names + list(kinds))

    return df.mapInArrow(releasing(run, lambda: own().known.clear()), schema)


def _id_array(ids: list[bytes], packed: bool) -> pa.Array:
    if packed:
        return pa.array(ids, pa.binary())
    flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32()), flat)


def encode_texts(df: DataFrame, text_col: str = "text", out: str = "ids", path: str = VOCABULARY,
                 pattern: str = public_tokenizers.PATTERN, packed: bool = False) -> DataFrame:
    """``df`` plus ``out``: the ids of each text, as an array of ints, or with ``packed`` as
    little-endian unsigned 32-bit integers in a binary. A column of that name is replaced."""

    def convert(column):
        return [_id_array(merger(path, pattern).encode(column.to_pylist()), packed)]

    kind = BinaryType() if packed else ArrayType(IntegerType())
    return _with_columns(df, text_col, {out: kind}, convert, lambda: merger(path, pattern))


def decode_ids(df: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str = VOCABULARY,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` plus ``out``: the bytes of each row's ids (array or packed; null gives no bytes)."""

    def convert(column):
        own = merger(path, pattern)
        if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            rows = [x or b"" for x in column.to_pylist()]
        else:
            rows = [np.array(x or [], "<u4").tobytes() for x in column.to_pylist()]
        return [pa.array([own.decode(x) for x in rows], pa.binary())]

    return _with_columns(df, ids_col, {out: BinaryType()}, convert, lambda: merger(path, pattern))


def round_trip(df: DataFrame, text_col: str = "text", out: str = "ids", back: str = "decoded", path: str = VOCABULARY,
               pattern: str = public_tokenizers.PATTERN, packed: bool = False) -> DataFrame:
    """``decode_ids`` of ``encode_texts`` in one pass: a running task has one Python worker with one vocabulary, not two."""

    def convert(column):
        own = merger(path, pattern)
        ids = own.encode(column.to_pylist())
        return [_id_array(ids, packed), pa.array([own.decode(x) for x in ids], pa.binary())]

    kind = BinaryType() if packed else ArrayType(IntegerType())
    return _with_columns(df, text_col, {out: kind, back: BinaryType()}, convert, lambda: merger(path, pattern))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Per row: its id, the number of ids, and the SHA-256 of the packed ids and of the decoded bytes."""
    own = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    made = round_trip(own, path=path, packed=True)
    return made.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
