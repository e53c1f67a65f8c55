from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key int, size string, _row string, features double, copies long"
LONG = " ".join(f"word{k % 977} of {k}," for k in range(12_000))
CLEAN = ("The harbour lay quiet that morning, and the boats had not yet come in. A man walked along the wall with two dogs. "
         "He spoke to nobody, for there was nobody to speak to, and the gulls kept their distance from him and from the dogs. ") * 3
TEXTS = [
    None, "", " \t\n", "one", "two words", "a b c a b c a b c", CLEAN, CLEAN, CLEAN.replace("quiet", "silent"), LONG,
    "Write to ann.lee@mail.example.com or +1 (203) 555-0142, host 10.20.30.40, card 4111 1111 1111 1111.",
    "line one is here\nline one is here\n\nline two\r\n  line two\n", "Ünïcode – “quoted” 中文 字 😀 é x　y  z   w", "# * $ % & | < >" * 20,
    "x" * 5000, "\x00 nul \x0b \x0c tabs\t\ttwo", "SHOUT!! LOUD!! " * 40, "<|endoftext|> <s> ▁▁ a▁b",
]


def rows_of(texts):
    rows = [(k, text, "en" if k % 3 else None, None if k % 5 == 4 else f"src{k % 3}", None if text is None else len(text), k, "s", "r", 0.5, 7)
            for k, text in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    rows.append((None, CLEAN, None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    rows.append((3, "same id, other text", "fr", "src0", 19, 1, "s", "r", 0.5, 7))
    return rows


@pytest.fixture(scope="session")
def edge_rows():
    return rows_of(TEXTS)


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """Nulls, empty and long texts, copies, a repeated row, missing ids and clashing column names."""
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
