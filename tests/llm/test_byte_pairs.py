from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from meterline.llm import byte_pairs
from meterline.llm.queries import BYTE_RANKS

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.ranks_of(path), special_tokens={})


def encoded(docs, path=BYTE_RANKS, **options):
    return byte_pairs.encode(docs, path, public_tokenizers.PATTERN, **options)


def random_texts(n, seed):
    rnd = random.Random(seed)
    scripts = ["etaoin shrdlu", "ab ", "中文字的是不了。", "あいうえおー", "é ñ ß'", "=-#\n ", "\x00\t\r\n  ", "0123 .,", "😀👍🏽‍"]
    texts = ["".join(rnd.choice(rnd.choice(scripts)) for _ in range(rnd.randrange(60))) for _ in range(n)]
    return texts + ["".join(chr(rnd.choice([rnd.randint(0, 0x2FFF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(40)) for _ in range(n // 4)]


@pytest.mark.parametrize("path", [BYTE_RANKS, MULTI])
def test_equals_the_library(spark, edge_rows, path):
    texts = [row[1] for row in edge_rows] + random_texts(60, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    ours, theirs = encoded(docs, path), library(path)
    got = {row.doc_id: row.ids for row in ours.collect()}
    assert got == {k: theirs.encode_ordinary(text or "") for k, text in enumerate(texts)}
    decoded = {row.doc_id: bytes(row.decoded) for row in byte_pairs.decode(ours, path).collect()}
    assert decoded == {k: (text or "").encode() for k, text in enumerate(texts)}


@pytest.mark.parametrize("most", [0, 40])
def test_listed_words_change_nothing(spark, most):
    texts = random_texts(20, 4) + ["the same the same the same", "the  the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert byte_pairs.frequent(docs, BYTE_RANKS, public_tokenizers.PATTERN, most).count() <= most
    got = {row.doc_id: row.ids for row in encoded(docs, most=most).collect()}
    assert got == {k: library(BYTE_RANKS).encode_ordinary(text) for k, text in enumerate(texts)}


@pytest.mark.parametrize("path", [BYTE_RANKS, MULTI])
def test_every_token_encodes_to_itself(path):
    """What the order of the fold rests on; the library skips the merges of a word that is a token."""
    ranks = byte_pairs.ranks_of(path)
    for token, rank in ranks.items():
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 1:
            pairs = [ranks.get(a + b, byte_pairs.NEVER) for a, b in zip(parts, parts[1:])]
            k = pairs.index(min(pairs))
            assert pairs[k] <= rank, token
            parts[k:k + 2] = [parts[k] + parts[k + 1]]


def test_long_words_by_sweep():
    sweep, theirs, rnd = byte_pairs.sweep(BYTE_RANKS), library(BYTE_RANKS), random.Random(8)
    for letters in ("x", "ab", "etaoinshr", "的一是不了人我在有他", "あいうえおー", "=-"):
        for n in (1, 2, 33, 700, 8_000):
            word = "".join(rnd.choice(letters) for _ in range(n)).encode()
            assert sweep(word) == theirs._encode_single_piece(word)


def test_memory_of_a_text_without_spaces():
    import tracemalloc

    rnd = random.Random(2)
    word = "".join(rnd.choices("etaoinshrdlucmfwyp", k=150_000)).encode()
    sweep = byte_pairs.sweep(BYTE_RANKS)
    tracemalloc.start()
    ids = sweep(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b"".join(byte_pairs.pieces_of(BYTE_RANKS)[k].as_py() for k in ids) == word
    assert peak < 100 * len(word) + 2_000_000


def test_clashing_columns_and_other_ids(spark, edge_docs, no_docs):
    kept = encoded(edge_docs, keep=("doc_id", "key", "size"))
    assert kept.columns == ["doc_id", "key", "size", "ids"] and kept.count() == edge_docs.count()
    assert encoded(no_docs).count() == 0 and byte_pairs.digests(encoded(no_docs), BYTE_RANKS).count() == 0
    strange = spark.createDataFrame([(1, [64, 60_000, -1, 65])], "doc_id long, ids array<int>")
    assert bytes(byte_pairs.decode(strange, BYTE_RANKS).first().decoded) == b"ab"


def test_digests(edge_docs, edge_rows):
    theirs = library(BYTE_RANKS)
    want = []
    for row in edge_rows:
        ids, text = theirs.encode_ordinary(row[1] or ""), (row[1] or "").encode()
        want.append((row[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text).hexdigest()))
    assert sorted(map(repr, map(tuple, byte_pairs.digests(encoded(edge_docs), BYTE_RANKS).collect()))) == sorted(map(repr, want))
