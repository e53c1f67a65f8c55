from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece

from meterline.llm import sentencepieces as s
from meterline.llm.queries import PIECE_BPE

PARTS = ["a", "b", "e", " ", "  ", "\n", "é", "▁", "　", "中", "😀", "\x00", "<s>", "<0x41>", "</s>", "the ", "ing", "\t", "\xa0", "▁▁", "1", ".", "er", "on", "﻿"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    return ["", " ", "  ", "   a", "▁", "a ", " a", "a" * 3000, "ab" * 700 + " " + "the" * 90] + [
        "".join(random.choices(PARTS, k=random.randint(1, 70))) for _ in range(4000)]


def test_ids_equal_the_library(library, texts):
    model = s.PieceModel(PIECE_BPE)
    assert model.encode(pa.array(texts, pa.large_string())).to_pylist() == library.encode(texts)


def test_both_agendas_agree(texts):
    model = s.PieceModel(PIECE_BPE)
    words = [("▁" + text.replace(" ", "▁"))[:s.ROUND_CHARACTERS] for text in texts[1:1500]]
    flat, counts = model.encode_short(words)
    at = 0
    for word, n in zip(words, counts):
        assert flat[at:at + n].tolist() == model.encode_word(word)
        at += n


def test_any_ids_decode_as_in_the_library(library, texts):
    random.seed(4)
    model = s.PieceModel(PIECE_BPE)
    spaces = [k for piece, k in model.ids.items() if piece.startswith("▁▁")]
    pools = [range(32_000), range(3, 259), [*range(0, 40), 29871, *spaces], [13, 29871, 35, 259]]
    lists = [random.choices(random.choice(pools), k=random.randint(0, 12)) for _ in range(3000)] + library.encode(texts[:300])
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))) == library.decode(lists)
    assert model.decode(pa.array(lists, pa.list_(pa.int32())).slice(7, 50)) == library.decode(lists[7:57])


def test_every_list_is_decoded_by_the_library(library, texts, monkeypatch):
    class Recorder:
        def __init__(self):
            self.seen = []

        def decode(self, lists, num_threads=None):
            self.seen += lists
            return library.decode(lists)

    model, recorder = s.PieceModel(PIECE_BPE), Recorder()
    monkeypatch.setattr(s, "DECODED_IDS", 50)
    model.library = recorder
    lists = library.encode(texts[:200])
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))) == library.decode(lists)
    assert recorder.seen == lists


def test_a_difference_is_an_error():
    model = s.PieceModel(PIECE_BPE)
    with pytest.raises(AssertionError):
        model.check_words([" the"], pa.array([[5]], pa.list_(pa.int32())))


def test_every_case(edge_docs, edge_rows, no_docs, library, rows):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for r in edge_rows:
        ids = library.encode(r[1] or "")
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert rows(s.digests(s.encode(edge_docs, PIECE_BPE))) == sorted(want, key=repr)
    assert s.encode(no_docs, PIECE_BPE).count() == 0
