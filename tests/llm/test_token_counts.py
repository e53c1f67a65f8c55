from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from meterline.llm import token_counts as t
from meterline.llm.queries import BYTE_BPE


def brute(library, text, rule):
    """Counts from the library's offsets, in code points."""
    text = text or ""
    begins = [0] + [k + 1 for k, c in enumerate(text) if c == "\n" and k + 1 < len(text)]
    ends = [*begins[1:], len(text)]
    counts, crossing = [0] * len(begins), [0] * len(begins)
    for a, b in library.encode(text, add_special_tokens=False).offsets:
        held = [max(0, min(b, end) - max(a, begin)) for begin, end in zip(begins, ends)]
        touched = [k for k, n in enumerate(held) if n]
        owner = {"most": held.index(max(held)), "first": touched[0], "last": touched[-1]}[rule]
        counts[owner] += 1
        crossing[owner] += len(touched) > 1
    return list(zip(range(len(begins)), begins, ends, counts, crossing))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.mark.parametrize("rule", t.RULES)
def test_against_library_offsets(spark, library, rule):
    random.seed(7)
    parts = ["\n", "\n\n", "\n\n\n", " ", "   ", "word", "é", "中", "😀", "\t", " the", "1"]
    texts = [None, "", "\n", "\n\n\n\n", "a\n\n\nb\n"] + ["".join(random.choices(parts, k=25)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in t.section_counts(docs, BYTE_BPE, rule).collect())
    want = [(k, *row) for k, text in enumerate(texts) for row in brute(library, text, rule)]
    assert got == want
    assert sum(row[5] for row in want) > 50  # tokens do cross boundaries here


def test_every_case(edge_docs, edge_rows, no_docs, library, rows):
    got = rows(t.section_counts(edge_docs, BYTE_BPE))
    assert got == sorted(((r[0], *row) for r in edge_rows for row in brute(library, r[1], "most")), key=repr)
    assert t.section_counts(no_docs, BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        t.section_counts(no_docs, BYTE_BPE, rule="best")


def test_added_tokens_are_one_token(spark, library):
    texts = ["a <|endoftext|>\nb<|endoftext|>\n\n<|endoftext|>é", "<|endof", "text|>", "中<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in t.section_counts(docs, BYTE_BPE).collect())
    assert got == [(k, *row) for k, text in enumerate(texts) for row in brute(library, text, "most")]
