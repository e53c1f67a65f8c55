from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterline.llm import token_blocks as t
from meterline.llm.queries import BYTE_BPE
from meterline.workspace import new_dir


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200), st.data())
@settings(max_examples=80, deadline=None)
def test_packing_round_trip(bits, values, data):
    ids = np.array(values, np.int64) % (1 << bits)
    payload = t.pack(ids, bits)
    assert len(payload) == -(-len(ids) * bits // 8)
    assert t.unpack(payload, bits, 0, len(ids)).tolist() == ids.tolist()
    begin = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(begin, len(ids)))
    assert t.unpack(payload, bits, begin, end).tolist() == ids[begin:end].tolist()


def test_width():
    assert [t.width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_units_give_the_same_ids(library):
    random.seed(5)
    parts = ["a", "word", " ", "  ", "\n", "\t", "'s", "'", "1", "23", ".", ",", "!?", "é", "–", "中", " ", "　", " ", "\x85", "\x1c", "😀", "#", "A"]
    texts = ["", " ", "\n", " x", "x "] + ["".join(random.choices(parts, k=random.randint(1, 30))) for _ in range(4000)]
    ids, counts = t.encode_texts(t.UnitEncoder(BYTE_BPE), pa.array(texts, pa.large_string()))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_round_trip_of_every_case(spark, edge_docs, edge_rows, no_docs, library):
    got = sorted((r for r in t.round_trip(edge_docs, BYTE_BPE).collect()), key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in got[:2]] == [True, True]
    assert [r["doc_id"] for r in got[2:]] == sorted(r[0] for r in edge_rows if r[0] is not None)
    position = 0
    for r in got:
        assert r["start"] == position
        position += r["n_tokens"]
    def digest(text):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((r[0] or -1, *digest(r[1])) for r in edge_rows)
    assert t.round_trip(no_docs, BYTE_BPE).count() == 0


def test_random_access(spark, edge_docs, library):
    path = new_dir(spark, "blocks")
    t.write_blocks(edge_docs.filter("doc_id >= 5"), path, BYTE_BPE, partitions=1)
    docs = edge_docs.filter("doc_id >= 5").orderBy("doc_id").collect()
    stream = [i for r in docs for i in [*library.encode(r["text"], add_special_tokens=False).ids, 0]]
    got = t.read_range(spark, path, 0, 700, 1500).orderBy("position").collect()
    assert got[0]["position"] == 700 and [i for r in got for i in r["ids"]] == stream[700:1500]


ADDED = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|>a", "a<|endoftext|>", " <|endoftext|> <|endoftext|><|endoftext|>", "x  <|endoftext|>\n\n",
         "<|endof", "text|>", "<|endoftext", "|>", "<|<|endoftext|>|>", "<|ENDOFTEXT|>", "A.<|endoftext|>'s", "中<|endoftext|>中"]


def test_added_tokens_in_texts(spark, library):
    """Also where two texts that touch would make one together."""
    random.seed(6)
    texts = ADDED + ["".join(random.choices([*ADDED, " ", "a", "\n", ""], k=6)) for _ in range(500)]
    ids, counts = t.encode_texts(t.UnitEncoder(BYTE_BPE), pa.array(texts, pa.large_string()))
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [k for own in want for k in own]
    assert sum(50256 in own for own in want) > 300
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    got = {row.doc_id: (row.n_tokens, row.ids_crc32) for row in t.round_trip(docs, BYTE_BPE).collect()}
    assert got == {k: (len(own) + 1, zlib.crc32(np.array([*own, 0], "<u4").tobytes())) for k, own in enumerate(want[:len(ADDED)])}
