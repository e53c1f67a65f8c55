r"""Near-duplicate groups by SimHash, with Golay-code keys.

*Fingerprint.* A text is lower-cased (A-Z only), cut into words ``[^\x20\x09-\x0D]+`` and read as
shingles of three words, repeats included; fewer words make one shingle, no words the
fingerprint zero. A bit of the fingerprint is 1 where over half of the shingles' XXH64 have it.

*Candidates.* The 64 bits are segments of 23, 23 and 18 bits. Of two fingerprints at most two bits
apart one segment is equal (pigeonhole), and every other differs in two bits at most. A segment
is decoded to the indices of all codewords of the binary Golay code (23, 12) within distance 4:
one where the nearest codeword is within 2, six where it is at 3. Words at distance 2 or less
always share such a codeword (any four bits lie in exactly one codeword of weight 7). A key is
therefore (segment i as it is, a codeword index of segment i + 1), for each i: 16 keys on
average, selective to 30 bits or more, and no link is lost. Fingerprints that share a key are
joined and the distance is verified.

*Hot keys.* Members of keys with more than ``JOIN_LIMIT`` fingerprints are linked exactly without
pairs: two fingerprints are at most two bits apart if and only if a third value is at most one
bit from both, so each value's members need a link to its smallest member only.

Groups are the connected components, found by alternating large and small stars over written
tables. Nothing grows with a group in one task: copies collapse by fingerprint first.

Defined cases: a null text counts as an empty one; a null id is a row like any other, and
``component_id`` is null only where no row of the component has an id; repeated rows each get a
row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import extended, lean, quoted, small_batches, text_or_empty, unused_name
from meterline.workspace import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
JOIN_LIMIT = 64
# Bits of the segments, from the lowest.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Generator polynomial of the binary Golay code (23, 12).
GENERATOR = 0b110001110101
CHUNK = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text as an unsigned number."""
    from xxhash import xxh64_digest

    found = text.lower().split()  # of bytes: A-Z alone, and the six ASCII white-space characters
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    begins = np.cumsum(lengths + 1) - lengths - 1
    last = min(size, len(found)) - 1
    begin, end = begins[:len(found) - last].tolist(), (begins + lengths)[last:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(begin), CHUNK):
        digests = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in zip(begin[k:k + CHUNK], end[k:k + CHUNK])])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begin)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed 64-bit number."""
    rows = docs.select(*(F.col(name) for name in keep), text_or_empty(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py()) for x in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values.view(np.int64), pa.int64())], names=[*batch.schema.names[:-1], "fp"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "fp long"))


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the bytes of a word; the nearest error of a syndrome; index offsets to near codewords.

    The code is systematic: the index of a codeword is its upper 12 bits. The offsets of a
    syndrome are those of the codewords within distance 4 to the nearest one, padded with -1.
    """
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    bytewise = np.array([[remainder(value << 8 * k) if value << 8 * k < 1 << 23 else 0 for value in range(256)] for k in range(3)], np.int64)
    errors = [0, *(1 << a for a in range(23)), *(1 << a | 1 << b for a in range(23) for b in range(a)),
              *(1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b))]
    leader = np.zeros(2048, np.int64)
    for error in errors:
        leader[remainder(error)] = error
    codewords = [index << 11 | remainder(index << 11) for index in range(4096)]
    light = [word for word in codewords if word.bit_count() == 7]
    offsets = np.full((2048, 6), -1, np.int64)
    offsets[:, 0] = 0
    for syndrome, error in enumerate(leader.tolist()):
        if error.bit_count() == 3:
            near = [word >> 11 for word in light if word & error == error]
            offsets[syndrome, 1:1 + len(near)] = near
    return bytewise, leader, offsets


def golay_indices(segment: np.ndarray) -> np.ndarray:
    """For each 23-bit word the indices of all codewords within distance 4, padded with -1."""
    bytewise, leader, offsets = golay_tables()
    syndrome = bytewise[0][segment & 255] ^ bytewise[1][segment >> 8 & 255] ^ bytewise[2][segment >> 16 & 255]
    nearest = (segment ^ leader[syndrome]) >> 11
    near = offsets[syndrome]
    return np.where(near < 0, -1, nearest[:, None] ^ near)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        parts = [(fps >> begin) & ((1 << size) - 1) for begin, size in SEGMENTS]
        for i in range(3):
            near = golay_indices(parts[(i + 1) % 3])
            keys = (i << 35 | parts[i] << 12)[:, None] | near
            used = near >= 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[used]), pa.array(np.repeat(fps, used.sum(axis=1)))], names=["key", "fp"])


def links(distinct: DataFrame, join_limit: int = JOIN_LIMIT) -> DataFrame:
    """Edges (a, b) between different fingerprints ``fp`` at most two bits apart.

    Every two such fingerprints are connected by a path of edges, and every edge joins two that
    are at most two bits apart. Below ``join_limit`` members a key yields all its links.
    """
    keyed = materialize(distinct.select("fp").mapInArrow(_keys, "key long, fp long"), "simhash-keys")
    hot = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > join_limit).select("key"), "simhash-hot")
    cold = keyed.join(hot, "key", "left_anti")
    a, b = cold.select("key", F.col("fp").alias("a")), cold.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = a.join(b, "key").filter((F.col("a") < F.col("b")) & near).select("a", "b")

    crowded = keyed.join(hot, "key", "left_semi").select("fp").distinct()
    around = materialize(crowded.select("fp", F.explode(F.array(
        F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")) for bit in range(64))
    )).alias("value")), "simhash-around")
    smallest = materialize(
        around.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("value", "a"),
        "simhash-smallest")
    stars = around.join(smallest, "value").filter(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of undirected edges (a, b); root is the smallest node of the component.

    Large star: every node links its larger neighbours to the smallest node around it. Small
    star: every node links its smaller neighbours and itself to the smallest of them. Both keep
    the components; they end in stars after a number of rounds that is logarithmic in practice.
    """
    def stored(df: DataFrame, label: str) -> DataFrame:
        return materialize(df, f"components-{label}")

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    state = digest(current)
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(current.select("lo", "hi"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-least")
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "small-least")
        moved = large.join(least, "hi").filter(F.col("lo") > F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = stored(moved.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "small")
        before, state = state, digest(current)
        if state == before:
            break
    roots = current.select("lo").distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("lo", F.col("lo")))


def roots(rows: DataFrame, join_limit: int = JOIN_LIMIT) -> DataFrame:
    """(fp, root) of every different fingerprint ``fp`` of the rows, as a written table."""
    distinct = materialize(rows.select("fp").distinct(), "simhash-distinct")
    linked = components(links(distinct, join_limit)).withColumnRenamed("node", "fp")
    return materialize(distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def groups(docs: DataFrame, join_limit: int = JOIN_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    rows = materialize(fingerprints(docs), "simhash-rows")
    root = roots(rows, join_limit)
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("id")).filter(F.col("id").isNotNull())
    smallest = materialize(ids.join(root, "fp").groupBy("root").agg(F.min("id").alias("component_id")), "simhash-ids")
    of_fp = materialize(root.join(smallest, "root", "left").select("fp", "component_id"), "simhash-components")
    return rows.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, join_limit: int = JOIN_LIMIT) -> DataFrame:
    """The document of each group with the smallest id (nulls last, then by a hash of the text).

    All columns of ``docs`` are kept. Of repeated rows, equal in id and text, one stays.
    """
    named = {wanted: unused_name(docs, wanted) for wanted in ("_id", "_none", "_hash")}
    keys = (F.coalesce(F.col("doc_id"), F.lit(0)).alias(named["_id"]), F.col("doc_id").isNull().alias(named["_none"]),
            F.xxhash64(text_or_empty("text")).alias(named["_hash"]))
    light = docs.select("text", *keys)
    rows = materialize(fingerprints(light, keep=tuple(named.values())), "simhash-rows")
    first = F.min(F.struct(named["_none"], named["_id"], named["_hash"])).alias("first")
    kept = materialize(rows.join(roots(rows, join_limit), "fp").groupBy("root").agg(first).select("first.*"), "simhash-kept")
    keyed = docs.select("*", *keys)
    return keyed.join(kept, list(named.values()), "left_semi").dropDuplicates(list(named.values())).select(*map(quoted, docs.columns))
