"""Token counts of sections by offset mapping: whole documents are encoded once.

Tokens of a byte-level vocabulary are runs of bytes, so their lengths give each token's place in
the text. Sections are intervals that cover the text; a token belongs to the section it lies in.
A token that crosses boundaries goes by ``rule``:

* ``most``: to the section that holds most of its characters, the earlier one of equals;
* ``first``: to the section its first character lies in;
* ``last``: to the section its last character lies in.

Characters are code points; a token that holds part of a character touches all of it, as in the
tokenizers library's offsets. Tokens are in order, so the interval join needs only the token at
each boundary; it runs over all texts of an Arrow batch at once.

The sections here are lines with their line ends. A string of an added token in a text is one token, as in
the library. Defined cases: a null or empty text is one
empty section without tokens; a text that ends with a line end has no empty last section;
repeated rows and null ids are rows like any other; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import extended, lean, plain_strings, small_batches, steps, text_bytes, text_or_empty
from meterline.llm.token_blocks import UnitEncoder, encode_texts, unit_encoder

RULES = ("most", "first", "last")
# Text per step of a task; several numbers per token are held at once.
STEP = 4 << 20


def token_bytes(encoder: UnitEncoder) -> np.ndarray:
    """Bytes of each id: a byte-level piece has one character per byte, an added token is plain text."""
    lengths = np.zeros(encoder.vocabulary, np.int32)
    for piece, k in encoder.tokenizer.get_vocab(with_added_tokens=False).items():
        lengths[k] = len(piece)
    for k, text in encoder.added.items():
        lengths[k] = len(text.encode())
    return lengths


def attribute(begins: np.ndarray, ends: np.ndarray, sections: np.ndarray, chars: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and the numbers of the tokens that cross a boundary.

    Tokens are byte intervals in order, ``sections`` the ascending first bytes of the sections,
    the first at 0, and ``chars`` the number of characters begun before each byte.
    """
    first = np.searchsorted(sections, begins, side="right") - 1
    last = np.searchsorted(sections, ends - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    owner = last.copy() if rule == "last" else first.copy()
    if rule == "most":
        for t in crossing.tolist():
            # Whole characters touched, so the first may begin before the token.
            low = int(chars[begins[t] + 1]) - 1
            high = int(chars[ends[t]])
            edges = [low, *chars[sections[first[t] + 1:last[t] + 1]].tolist(), high]
            owner[t] = first[t] + int(np.argmax(np.diff(edges)))
    return owner, crossing


def section_counts(docs: DataFrame, tokenizer: str, rule: str = "most", text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, section (from 0), begin, end (code points), n_tokens and n_crossing of every line.

    n_crossing counts the section's tokens that reach into another section.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(*(F.col(name) for name in keep), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(tokenizer)
        lengths = token_bytes(encoder)
        for batch in batches:
            for step in steps(batch, "_text", STEP):
                texts = plain_strings(step.column(step.num_columns - 1))
                data, offsets = text_bytes(texts)
                ids, _ = encode_texts(encoder, texts)
                ends = np.cumsum(lengths[ids], dtype=np.int32)
                begins = ends - lengths[ids]
                # Characters begun before each byte; continuation bytes begin none.
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
                # Sections begin with texts and behind line ends.
                inner = np.flatnonzero(data == 0x0A) + 1
                filled = offsets[:-1][np.diff(offsets) > 0]
                sections = np.union1d(filled, inner[inner < len(data)])
                owner, crossing = attribute(begins, ends, sections, chars, rule) if len(ids) else (np.empty(0, np.int64),) * 2
                tokens = np.bincount(owner, minlength=len(sections))
                crossed = np.bincount(owner[crossing], minlength=len(sections))
                # Empty texts are added as sections of their own, in the order of the texts.
                empty = np.flatnonzero(np.diff(offsets) == 0)
                text_of = np.concatenate([np.searchsorted(offsets, sections, side="right") - 1, empty])
                low, high = chars[np.append(sections, len(data))[:-1]], chars[np.append(sections, len(data))[1:]]
                pad = np.zeros(len(empty), np.int64)
                low, high, tokens, crossed = (np.concatenate([a, pad]).astype(np.int64) for a in (low, high, tokens, crossed))
                order = np.argsort(text_of, kind="stable")
                text_of, low, high, tokens, crossed = text_of[order], low[order], high[order], tokens[order], crossed[order]
                base = chars[offsets[:-1]][text_of]
                nonempty = high > low
                number = np.arange(len(text_of)) - np.searchsorted(text_of, text_of, side="left")
                columns = [column.take(pa.array(text_of)) for column in step.columns[:-1]]
                yield pa.RecordBatch.from_arrays([
                    *columns, pa.array(number.astype(np.int32)), pa.array(np.where(nonempty, low - base, 0)),
                    pa.array(np.where(nonempty, high - base, 0)), pa.array(tokens), pa.array(crossed),
                ], names=[*step.schema.names[:-1], "section", "begin", "end", "n_tokens", "n_crossing"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "section int, begin long, end long, n_tokens long, n_crossing long"))
