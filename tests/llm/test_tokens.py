import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabula.llm import byte_bpe, token_counts, token_shards
from tabula.llm.common import workspace
from tests.llm.cases import CASES, awkward, empty

SF = "/root/testdata/sf0.001"


def reference_encoding():
    return token_counts._encoding(byte_bpe.VOCABULARY, byte_bpe.public_tokenizers.PATTERN)


def test_merges_equal_the_library():
    own, ref = byte_bpe.merger(byte_bpe.VOCABULARY, byte_bpe.public_tokenizers.PATTERN), reference_encoding()
    rng = random.Random(1)
    texts = ["".join(rng.choice("aabbcc ddeé中\U0001f600 \n\t'1234!!") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += ["a" * 5000, "ab" * 700, " " * 3000, "x" * 64, "y" * 65, "", None] + [c[1] for c in CASES]
    texts += [chr(c) + "x " + chr(c) for c in [*range(0, 0xD800, 7), *range(0xE000, 0x11000, 7)]]
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == ref.encode_ordinary(text or "")
        assert own.decode(packed) == (text or "").encode()


def test_rows_and_lists_of_trees_agree():
    own = byte_bpe.merger(byte_bpe.VOCABULARY, byte_bpe.public_tokenizers.PATTERN)
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"aeinrst tion") for _ in range(rng.randint(1, 64))) for _ in range(200)]
    assert own.merge_rows(pieces, 64) == [own.merge_long(p) for p in pieces]


def test_bpe_digests(spark):
    df = awkward(spark)
    got = sorted(map(tuple, byte_bpe.digests(df).collect()), key=str)
    want = []
    for doc_id, text, *_ in CASES:
        ids = reference_encoding().encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    lists = byte_bpe.decode_ids(byte_bpe.encode_texts(df)).select("text", "ids", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and r.ids == reference_encoding().encode_ordinary(r.text or "") for r in lists)
    assert byte_bpe.digests(empty(spark)).count() == 0


def test_token_histogram_answers_every_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    enc = token_counts._encoding(token_counts.VOCABULARY, token_counts.public_tokenizers.PATTERN)
    lengths = sorted(len(enc.encode_ordinary(r.text)) for r in docs.select("text").collect())
    hist = token_counts.length_histogram(token_counts.encoded_lengths(docs)).cache()
    for block in (64, token_counts.BLOCK):
        sums = token_counts.suffix_sums(hist, block)
        for r in sums.collect():
            assert r.docs_at_least == sum(x >= r.n_tokens for x in lengths)
            assert r.tokens_at_least == sum(x for x in lengths if x >= r.n_tokens)
            assert r.docs_up_to == sum(x <= r.n_tokens for x in lengths)
            assert r.truncated_total == sum(min(x, r.n_tokens) for x in lengths)
    limits = [0, 1, 17, 128, lengths[5], 10**9]
    for r in token_counts.at_limits(sums, limits).collect():
        assert r.tokens_kept == sum(min(x, r.max_tokens) for x in lengths) and r.docs_cut == sum(x > r.max_tokens for x in lengths)
        assert r.tokens_lost == sum(max(x - r.max_tokens, 0) for x in lengths)
    for r in token_counts.quantiles(sums, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == lengths[int(np.ceil(r.share * len(lengths))) - 1]


def test_token_histogram_awkward_rows(spark):
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.encoded_lengths(awkward(spark))))
    zero = sums.where("n_tokens = 0").first()
    assert zero.n_docs == 2 and zero.docs_at_least == 10 and zero.truncated_total == 0
    none = token_counts.suffix_sums(token_counts.length_histogram(token_counts.encoded_lengths(empty(spark))))
    assert none.count() == 0
    assert [tuple(r) for r in token_counts.at_limits(none, [5]).collect()] == [(5, 0, 0, 0)]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(token_shards.VOCABULARY)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def test_word_encoder_equals_the_library(library):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aabbccΣσς ddeé中\U0001f600 \n\t\r\x0b'1234!!.,́  \u0085") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    texts += ["x" + chr(c) + ". " + chr(c) + "́, " + chr(c) for c in [*range(0, 0xD800, 5), *range(0xE000, 0x11000, 5)]]
    texts += [f"x{chr(c)} {chr(c)} {chr(c)}. y{chr(c)}{chr(d)}z," for c in range(0x21, 0x260) for d in (c, 0x131, 0xDF)]
    texts += ["<|endoftext|> it's, don't. A.B., end.", None, ""]
    texts += [f"hello{a}<|endoftext|>{b}world <|startoftext|>. <|ENDOFTEXT|> <|endoftext" for a in ("", " ", ".") for b in ("", " ", ",")]
    texts += ["ab" * 500_000 + ". and " + "7é" * 1000]  # a word of a megabyte
    own = token_shards.WordEncoder(token_shards.VOCABULARY, 2)
    own.encode(texts[::7])
    own.old, own.young = own.young, {}  # as after a change of generations
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u2").tolist() + [1] == library(text), repr(text)


def test_shards_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = workspace(spark, "test-shards")
    token_shards.write_shards(docs.repartition(5), out, shard_docs=7, shard_bytes=4000)
    want, start = {}, 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = library(r.text)
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_shards.digests(spark, out).collect()} == want
    some = [0, 3, 77, 10**9]
    assert {r.doc_id: len(r.ids) for r in token_shards.lookup(spark, out, some).collect()} == {k: want[k][1] for k in some[:-1]}
    assert token_shards.read_shards(spark, out).count() == len(want)
    shards = spark.read.parquet(f"{out}/shards")
    assert shards.count() > 20 and shards.select("dict_hash").distinct().count() == 1


def test_shards_awkward_rows(spark, library):
    out = workspace(spark, "test-shards")
    token_shards.write_shards(awkward(spark), out, shard_docs=2)
    order = sorted(CASES, key=lambda c: (c[0] is not None, c[0] or 0))
    got = sorted(((r.start, r.doc_id, r.n_tokens) for r in token_shards.digests(spark, out).collect()))
    want, start = [], 0
    for doc_id, text, *_ in order:
        want.append((start, doc_id, len(library(text))))
        start += want[-1][2]
    assert got == want
    assert [r.doc_id for r in token_shards.lookup(spark, out, [-7]).collect()] == [-7]
    out = workspace(spark, "test-shards")
    token_shards.write_shards(empty(spark), out)
    assert token_shards.digests(spark, out).count() == 0


def test_round_trip_is_encode_and_decode_in_one_pass(spark):
    texts = ["Hello  wörld\n\n 123", "", None, "你好 \U0001f600", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for packed in (False, True):
        made = byte_bpe.round_trip(docs, packed=packed)
        two = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, packed=packed))
        assert made.schema == two.schema and sorted(made.collect()) == sorted(two.collect())
        assert [bytes(r.decoded) for r in made.orderBy("doc_id").collect()] == [(t or "").encode() for t in texts]
    for df in (byte_bpe.digests(docs), made):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
