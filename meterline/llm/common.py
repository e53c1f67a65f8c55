"""What several operators share: the tables, words, fingerprints of rows, and text in Arrow batches."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that one step inside a task holds; longer single texts are steps of their own.
STEP_BYTES = 8 << 20
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text as a string; a null counts as an empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def extended(rows: DataFrame, more: str, without: int = 1) -> T.StructType:
    """The schema of ``rows`` without its last columns, and with those of the DDL text ``more``."""
    fields = rows.schema.fields[:len(rows.schema.fields) - without]
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def unused_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, ignoring case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def plain_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of 64-bit offsets without nulls, which start at 0."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    return pc.fill_null(array.cast(pa.large_string()), "")


def byte_offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text begins (with the end of the last)."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = byte_offsets(texts)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of ``df``'s session by ``BATCH_BYTES``, unless a smaller bound is set.

    Spark's own bound of 64 MB per batch, task and direction is large beside the rest of a task.
    """
    conf = df.sparkSession.conf
    if int(str(conf.get(_BATCH_SETTING)).rstrip("b")) > BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over Arrow batches, with freed memory given back to the system after each result.

    Python workers live on for later stages and would keep what the largest step once needed.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for result in run(batches):
            yield result
            give_back()
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def steps(batch: pa.RecordBatch, text: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each; every slice has a row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _byte_set(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


_LETTER = _byte_set(bytes(range(65, 91)) + bytes(range(97, 123)))
_VISIBLE = _byte_set(bytes(range(0x21, 0x7F)))
# An apostrophe may belong to the letters after it.
_MARK = _VISIBLE & ~_LETTER & ~_byte_set(b"0123456789'")


def _whole_places(data: bytes, offsets: np.ndarray, whole: re.Pattern[bytes]) -> Iterator[tuple[int, int]]:
    """The leftmost matches of ``whole`` that do not overlap, each inside one text."""
    place = 0
    while (found := whole.search(data, place)) is not None:
        begin, end = found.span()
        if np.searchsorted(offsets, begin, side="right") == np.searchsorted(offsets, end, side="left"):
            yield begin, end
            place = end
        else:  # two texts that touch
            place = begin + 1


def units(texts: pa.Array, marks: bool = False, whole: re.Pattern[bytes] | None = None) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Cut texts into units that are encoded independently, and encode the units as a dictionary.

    A cut lies before each space whose preceding character is no white space of any kind, so
    runs of white space are never cut. Byte-level pre-tokenizers that attach one space to the
    word after it, and merges over pieces that hold a space at their start only, never reach
    over such a cut: each distinct unit can be encoded once, and the result is exact.

    ``marks`` adds the cuts where those pre-tokenizers end a token in any case: between an ASCII
    letter and an ASCII mark other than the apostrophe, and around a line end between visible
    ASCII characters. There are fewer distinct units then.

    What ``whole`` matches is a unit of its own, whatever stands beside it.

    Returns the units of all texts in order, and for each text the number of its first unit
    (with the number of units at the end).
    """
    data, offsets = text_bytes(texts)
    spaces = np.flatnonzero(data == 0x20)
    spaces = spaces[spaces > 2]  # a cut that is left out does no harm
    last, lead2, lead3 = data[spaces - 1], data[spaces - 2], data[spaces - 3]
    # White space beyond ASCII has the lead bytes C2 (two bytes) and E1 to E3 (three bytes).
    inside = (last <= 0x20) | (lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))
    begins = np.zeros(len(data) + 1, bool)
    begins[spaces[~inside]] = True
    if marks and len(data) > 1:
        begins[1:-1] |= _MARK[data[1:]] & _LETTER[data[:-1]]
        ends = np.flatnonzero(data == 0x0A)
        ends = ends[(ends > 0) & (ends < len(data) - 1)]
        ends = ends[_VISIBLE[data[ends - 1]] & _VISIBLE[data[ends + 1]]]
        begins[ends] = begins[ends + 1] = True
    if whole is not None:
        for begin, end in _whole_places(data.tobytes(), offsets, whole):
            begins[begin + 1:end] = False
            begins[begin] = begins[end] = True
    begins[offsets] = True
    begins[len(data)] = False
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    return pieces.dictionary_encode(), np.searchsorted(starts, offsets)


def gather(lists: pa.Array, picks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of the picked lists in a row, and the length of each picked list."""
    taken = lists.take(picks)
    return taken.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(taken).to_numpy(zero_copy_only=False).astype(np.int64)
