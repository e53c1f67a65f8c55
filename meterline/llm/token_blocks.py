r"""Token ids as fixed-width bit-packed blocks.

Each id takes the fewest bits that hold the vocabulary. A block holds the ids of whole
documents, at least ``BLOCK_IDS`` of them unless it is the last of its shard; a shard is what one
task wrote, and shards follow each other in the order of the documents.

The files are Parquet with one row per block:

==========  =============================================================================
shard       number of the shard; shards ascend with the documents
block       number of the block inside its shard
first       ids of the shard before this block
n_ids       ids in the block
bits        bits per id
doc_ids     the documents of the block, in order
doc_ids_n   ids of each of them, the end id included
payload     the ids, lowest bit first, id k at bit ``k * bits``; padded to whole bytes
==========  =============================================================================

``first`` and ``n_ids`` are the block offsets: the place of any id of a block is arithmetic, so
numpy unpacks a whole block or a range of ids at once, and a reader finds the block of a position
from the column statistics.

Documents are ordered by id (nulls first), then by a hash of the text, then by the text, so one
id that many rows share is spread over tasks. Ids are those that the tokenizers library gives without
adding special tokens; a text that holds an added token's string, like ``<|endoftext|>``, has that token's id
there, as in the library. Defined cases: a null or empty text has the end id
alone; repeated rows are encoded each; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.common import gather, lean, plain_strings, small_batches, steps, text_or_empty, units
from meterline.workspace import materialize, new_dir

BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = (
    "shard int, block int, first long, n_ids long, bits int, doc_ids array<long>, doc_ids_n array<long>, payload binary"
)
# Distinct units whose ids a Python worker remembers between batches; others are encoded again.
REMEMBERED_UNITS = 300_000
# Text per step of a task.
STEP = 16 << 20


def width(vocabulary: int) -> int:
    """Bits per id for ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1, count=bits, bitorder="little").reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` (exclusive) of a block, reading only their bytes."""
    if end <= begin:
        return np.empty(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", end - begin, begin * bits // 8).astype(np.uint32)
    low, high = begin * bits, end * bits
    part = np.frombuffer(payload, np.uint8)[low // 8:(high + 7) // 8]
    flags = np.unpackbits(part, bitorder="little")[low % 8:low % 8 + high - low].reshape(-1, bits)
    wide = np.zeros((end - begin, 32), np.uint8)
    wide[:, :bits] = flags
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint32)


class UnitEncoder:
    """Ids of units from the tokenizers library; frequent units are remembered up to a bound."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        # Texts are cut at added tokens before anything else; the library gives such a unit the token's id.
        self.added = {k: token.content for k, token in self.tokenizer.get_added_tokens_decoder().items()}
        if any(token.lstrip or token.rstrip or token.single_word for token in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that depend on what stands beside them are not supported")
        longest = sorted((text.encode() for text in self.added.values()), key=len, reverse=True)
        self.whole = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.known: dict[str, bytes] = {}

    def lists(self, texts: list[str]) -> pa.ListArray:
        """The ids of each text as one list array."""
        known = self.known
        found = [known.get(text) for text in texts]
        new = [k for k, ids in enumerate(found) if ids is None]
        for begin in range(0, len(new), 8192):
            part = new[begin:begin + 8192]
            for k, encoding in zip(part, self.tokenizer.encode_batch_fast([texts[k] for k in part], add_special_tokens=False)):
                ids = found[k] = array("i", encoding.ids).tobytes()
                if len(known) < REMEMBERED_UNITS and len(ids) < 256:
                    known[texts[k]] = ids
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))


@lru_cache(maxsize=2)
def unit_encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


def encode_texts(encoder: UnitEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and the number of ids of each text."""
    pieces, first = units(texts, marks=True, whole=encoder.whole)
    ids, lengths = gather(encoder.lists(pieces.dictionary.to_pylist()), pieces.indices)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ids, np.diff(ends[first])


def _write_blocks(path: str, end_id: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(path)
        bits, shard = width(encoder.vocabulary), TaskContext.get().partitionId()
        held: list[tuple[object, np.ndarray]] = []
        block = first = n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, n_held, held
            ids = np.concatenate([x[1] for x in held])
            row = pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "first": first, "n_ids": len(ids), "bits": bits,
                "doc_ids": [x[0] for x in held], "doc_ids_n": [len(x[1]) for x in held], "payload": pack(ids, bits),
            }], schema=_BLOCK_ARROW)
            block, first, n_held, held = block + 1, first + len(ids), 0, []
            return row

        for batch in batches:
            for step in steps(batch, "text", STEP):
                ids, counts = encode_texts(encoder, plain_strings(step.column(1)))
                ends = np.cumsum(counts)
                for doc_id, begin, end in zip(step.column(0).to_pylist(), ends - counts, ends):
                    held.append((doc_id, np.append(ids[begin:end], np.int32(end_id))))
                    n_held += end - begin + 1
                    if n_held >= BLOCK_IDS:
                        yield flush()
        if held:
            yield flush()

    return blocks


_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_ids_n", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Encode all documents in ascending order of id and write their blocks to ``path``.

    ``tokenizer`` is the path of a byte-level vocabulary file on every machine. ``partitions``
    is the number of shards; the session's shuffle partitions by default.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    rows = rows.withColumn("salt", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, "doc_id", "salt").sortWithinPartitions("doc_id", "salt", "text")
    # The bits are spent already; light compression is enough.
    small_batches(ordered).select("doc_id", "text").mapInArrow(lean(_write_blocks(tokenizer, end_id)), BLOCK_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the block files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The shards' totals are one row per
    shard, so their running sum is small whatever the corpus holds.
    """
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = materialize(
        totals.select("shard", (F.sum("total").over(W.orderBy("shard")) - F.col("total")).alias("base")), "token-shards")
    return (stored.join(before, "shard")
            .select((F.col("base") + F.col("first")).alias("first"), "bits", "doc_ids", "doc_ids_n", "payload")
            .mapInArrow(lean(_read_blocks), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, bits, doc_ids, counts, payload in zip(*(batch.column(k) for k in range(5))):
            lengths = np.array(counts.as_py(), np.int64)
            ends = np.cumsum(lengths)
            ids = unpack(payload.as_py(), bits.as_py(), 0, int(ends[-1])).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array(doc_ids.as_py(), pa.int64()), pa.array(first.as_py() + ends - lengths),
                pa.array(lengths), pa.array([zlib.crc32(ids[a:b]) for a, b in zip(ends - lengths, ends)], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_range(spark: SparkSession, path: str, shard: int, begin: int, end: int) -> DataFrame:
    """Ids ``begin`` to ``end`` of one shard, one row (first position, ids) per block touched."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n_ids, bits, payload in zip(*(batch.column(k).to_pylist() for k in range(4))):
                low, high = max(begin - first, 0), min(end - first, n_ids)
                ids = unpack(payload, bits, low, high)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + low]), pa.array([ids.tolist()], pa.list_(pa.int64()))], names=["position", "ids"])

    stored = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    touched = stored.filter((F.col("shard") == shard) & (F.col("first") < end) & (F.col("first") + F.col("n_ids") > begin))
    return touched.select("first", "n_ids", "bits", "payload").mapInArrow(cut, "position long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the blocks to the shared folder and read the documents back from them."""
    path = new_dir(docs.sparkSession, "token-blocks")
    write_blocks(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
