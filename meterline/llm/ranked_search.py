r"""Ranked lexical search by NRA over segments of an inverted index.

``build_index`` writes one row per segment (``SEGMENT`` bytes of text, one text at least): the terms
of its documents in order, and per term the documents that hold it with their frequencies. Nothing
is shuffled, and a segment is as large as its texts whatever the corpus holds. Each is a row group
of its own: what a task holds is bounded by a segment, not by the part of the corpus it is given.

``search`` knows N, L and every term's df from the segments' own counts, so the weights hold for the
whole corpus. A task reads its segments one after the other. In a segment the list of a term is
sorted by impact; for each item the lists of its terms are read side by side, best impacts first, in
blocks that grow. A document's lower score is the sum of the impacts read for it; its upper score
adds, for every list in which it has not been read yet, the impact where that list stands. Once
unseen documents cannot reach the ``k``-th best lower score, only documents whose upper score reaches it stay;
the reads go on until no document is left whose two scores differ. The ``k``-th score of the
segments before is where the next one starts, so later segments end early. Every task gives its
``k`` best documents per item, the best of all tasks are the result.

Items are taken in blocks of ``BLOCK_TERMS`` terms (one item at least): what is sent to the tasks
is bounded, a larger set of items costs more passes over the index. ``score`` is as in BM25, in whole
numbers: see ``impacts``. Sums stay below 2^63 for fewer than 10^8 terms an item.

Defined cases: null texts hold no term; items and documents without a common term with positive weight give no row;
every row of the documents is ranked for itself, also where ids repeat; equal scores go by
ascending id, null ids last, equal rows in any order; each row of the items is an item; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.common import lean, plain_strings, small_batches, steps, text_bytes, text_or_empty
from meterline.workspace import materialize, new_dir

SEGMENT = 4 << 20
BLOCK_TERMS = 1 << 20
# Postings of a list in the first block; each block is so many times the one before.
FIRST_BLOCK, GROWTH = 64, 4
SCHEMA = (
    "doc_ids array<long>, lengths array<long>, terms array<string>, counts array<int>, postings binary, frequencies binary")
_ARROW = pa.schema([
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
    ("postings", pa.binary()), ("frequencies", pa.binary()),
])
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of all texts in order, and how many each text has."""
    data, offsets = text_bytes(texts)
    member = np.concatenate([[False], _TERM[data]])
    # Texts that touch must not join their terms.
    begins = member[1:] & ~member[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] |= member[1:][edges]
    starts = np.flatnonzero(begins)
    kept = data[member[1:]]
    kept[(kept >= 0x41) & (kept <= 0x5A)] += 0x20
    bounds = np.zeros(len(starts) + 1, np.int64)
    if len(starts):  # all term bytes from a start to the next are of one term
        np.cumsum(np.add.reduceat(member[1:], starts, dtype=np.int64), out=bounds[1:])
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(kept))
    return pieces.dictionary_encode(), np.diff(np.searchsorted(starts, offsets))


def _postings(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, postings per term, then document and frequency of every posting; terms per text."""
    found, lengths = terms_of(texts)
    key = found.indices.to_numpy().astype(np.int64) * max(len(texts), 1) + np.repeat(np.arange(len(texts)), lengths)
    key, frequency = np.unique(key, return_counts=True)
    term, doc = np.divmod(key, max(len(texts), 1))
    return found.dictionary, np.bincount(term, minlength=len(found.dictionary)), doc, frequency, lengths


def _packed(numbers: np.ndarray) -> pa.Array:
    """One binary value of 32-bit numbers, small on its way through the JVM."""
    return pa.array([pa.compress(numbers.astype("<i4").tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unpacked(packed: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd"), "<i4")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text", SEGMENT):
            terms, counts, docs, frequencies, lengths = _postings(plain_strings(step.column(1)))
            lists = [step.column(0), pa.array(lengths, pa.int64()), terms.cast(pa.string()), pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays([
                *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
                _packed(docs), _packed(frequencies),
            ], schema=_ARROW)


def build_index(docs: DataFrame, path: str) -> None:
    """Write the segments of all documents to ``path``.

    Parquet would close a row group or a page after 100 rows at the earliest, whatever their size, and
    Spark reads up to 4096 rows of a row group at once: a whole file of segments.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    segments = small_batches(rows).mapInArrow(lean(_segments), SCHEMA)
    segments.write.option("parquet.block.row.count.limit", 1).parquet(path)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text"):
            terms, counts, items, repeats, _ = _postings(plain_strings(step.column(2)))
            rows = step.take(pa.array(items))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), terms.take(pa.array(np.repeat(np.arange(len(counts)), counts))).cast(pa.string()), pa.array(repeats, pa.int64())],
                names=["item", "item_id", "term", "repeats"])


def weighted_terms(index: DataFrame, items: DataFrame) -> DataFrame:
    """item (a number per row of ``items``), item_id, term, repeats and weight of the terms that the documents hold; stored."""
    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), text_or_empty("text").alias("text"))
    asked = materialize(small_batches(rows).mapInArrow(lean(_item_terms), "item long, item_id long, term string, repeats long"), "search-items")
    held = index.select(F.inline(F.arrays_zip("terms", "counts")))
    known = held.join(asked.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
    df = known.groupBy(F.col("terms").alias("term")).agg(F.sum("counts").alias("df"))
    n = index.select(F.sum(F.size(F.filter("lengths", lambda x: x > 0))).cast("long").alias("n_docs")).first().n_docs or 0
    weight = F.floor(1000 * F.log(F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1)))
    return materialize(asked.join(df, "term").select("item", "item_id", "term", "repeats", weight.alias("weight")).filter("weight > 0"), "search-terms")


class Items:
    """A block of items as the tasks hold it."""

    def __init__(self, rows: list[Row]) -> None:
        self.terms = pa.array(sorted({row.term for row in rows}), pa.string())
        place = {term: k for k, term in enumerate(self.terms.to_pylist())}
        self.weights = np.zeros(len(place), np.int64)
        self.asked: dict[int, tuple[int | None, np.ndarray, np.ndarray]] = {}
        lists: dict[int, list[Row]] = {}
        for row in rows:
            self.weights[place[row.term]] = row.weight
            lists.setdefault(row.item, []).append(row)
        for item, own in lists.items():
            self.asked[item] = (own[0].item_id, np.array([place[row.term] for row in own]), np.array([row.repeats for row in own], np.int64))


def _blocks(rows: DataFrame) -> Iterator[list[Row]]:
    """Whole items, ``BLOCK_TERMS`` rows at a time."""
    held: list[Row] = []
    for row in rows.orderBy("item", "term").toLocalIterator():
        if len(held) >= BLOCK_TERMS and row.item != held[-1].item:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def impacts(frequency: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one posting adds per unit of weight: frequent in the document, and the document not long."""
    if int(length.max(initial=0)) * 25 * n_docs >= 1 << 63:
        length = length.astype(object)
    measure = (75 + 25 * length * n_docs // n_terms).astype(np.int64)
    return 1_000_000_000 * frequency // (1000 * frequency + 12 * measure)


class Lists:
    """The lists of a segment that a block of items can ask for, each by falling impact."""

    def __init__(self, segment: dict, items: Items, n_docs: int, n_terms: int) -> None:
        self.n = len(segment["doc_ids"])
        counts = segment["counts"].to_numpy().astype(np.int64)
        begins = np.cumsum(counts) - counts
        at = pc.index_in(items.terms, value_set=segment["terms"])
        held = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        own = at.drop_null().to_numpy().astype(np.int64)
        size = counts[own]
        ends = np.cumsum(size)
        place = np.repeat(begins[own] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        n = int(counts.sum())
        docs = _unpacked(segment["postings"], n)[place]
        frequency = _unpacked(segment["frequencies"], n)[place].astype(np.int64)
        value = impacts(frequency, segment["lengths"].to_numpy()[docs], n_docs, n_terms) * np.repeat(items.weights[held], size)
        order = np.lexsort((-value, np.repeat(np.arange(len(own)), size)))
        self.docs, self.values = docs[order], value[order]
        self.first = np.full(len(items.terms), -1, np.int64)
        self.first[held], self.size = ends - size, np.zeros(len(items.terms), np.int64)
        self.size[held] = size


def nra(lists: Lists, terms: np.ndarray, repeats: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a segment that can be among the ``k`` best, with their scores, and the postings read.

    ``least`` is a score that ``k`` documents of other segments reach (0: none).
    """
    there = lists.size[terms] > 0
    terms, repeats = terms[there], repeats[there]
    first, size = lists.first[terms], lists.size[terms]
    low = np.zeros(lists.n, np.int64)
    seen = np.zeros((len(terms), lists.n), bool)
    alive: np.ndarray | None = None  # after the membership is bounded: the documents that may still belong
    depth, step, read = 0, FIRST_BLOCK, 0
    while True:
        frontier = np.zeros(len(terms), np.int64)
        for t in range(len(terms)):
            begin, end = first[t] + min(depth, size[t]), first[t] + min(depth + step, size[t])
            docs, values = lists.docs[begin:end], lists.values[begin:end]
            read += len(docs)
            low[docs] += values * repeats[t]
            seen[t, docs] = True
            if end < first[t] + size[t]:
                frontier[t] = lists.values[end] * repeats[t]
        depth, step = depth + step, step * GROWTH
        ahead = int(frontier.sum())
        bar = max(least, int(np.partition(low, lists.n - k)[lists.n - k]) if lists.n >= k else 0, 1)
        if alive is None:
            if ahead >= bar and ahead > 0:
                continue  # a document not seen yet could still belong
            alive = np.flatnonzero(low > 0)
        upper = low[alive] + ahead - frontier @ seen[:, alive]
        alive = alive[upper >= bar]
        if ahead == 0 or bool((low[alive] + ahead - frontier @ seen[:, alive] == low[alive]).all()):
            return alive, low[alive], read


def _search(items: Broadcast, k: int, n_docs: int, n_terms: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bool, int]]] = {}  # (-score, id is null, id), the best first
        for batch in batches:
            for row in range(batch.num_rows):
                segment = {name: batch.column(place)[row] for place, name in enumerate(_ARROW.names)}
                segment = {name: x.as_buffer() if name in ("postings", "frequencies") else x.values for name, x in segment.items()}
                lists = Lists(segment, items.value, n_docs, n_terms)
                ids = segment["doc_ids"]
                for item, (_, terms, repeats) in items.value.asked.items():
                    own = best.setdefault(item, [])
                    docs, scores, _ = nra(lists, terms, repeats, k, -own[-1][0] if len(own) == k else 0)
                    found = [(-s, x is None, x or 0) for s, x in zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist())]
                    best[item] = sorted([*own, *found])[:k]
        rows = [(items.value.asked[item][0], item, None if null else x, -score) for item, own in best.items() for score, null, x in own]
        for begin in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows[begin:begin + 10_000])], names=["item_id", "item", "doc_id", "score"])

    return search


def search(spark: SparkSession, path: str, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of the index for every row of ``items``."""
    index = spark.read.schema(SCHEMA).parquet(path)
    totals = index.select(
        F.sum(F.size(F.filter("lengths", lambda x: x > 0))).cast("long").alias("n_docs"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_terms")).first()
    found = spark.createDataFrame([], "item_id long, item long, doc_id long, score long")
    for rows in _blocks(weighted_terms(index, items)):
        block = spark.sparkContext.broadcast(Items(rows))
        found = found.unionByName(small_batches(index).mapInArrow(
            lean(_search(block, k, totals.n_docs, totals.n_terms)), "item_id long, item long, doc_id long, score long"))
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))).alias("rank")
    return found.select("item_id", rank, "doc_id", "score").filter(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index the documents in the shared folder and search them for every item."""
    path = new_dir(docs.sparkSession, "search-index")
    build_index(docs, path)
    return search(docs.sparkSession, path, items, k)
