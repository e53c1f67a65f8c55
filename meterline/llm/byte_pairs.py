r"""Byte-level BPE by ranks: Spark's higher-order functions fold the ranked merges of distinct words.

A vocabulary is a file of base64 tokens with their ranks, which are their ids. In Spark, bytes are
carried as strings with one character per byte (ISO-8859-1), so that they can be keys of a map.

``merge`` encodes one word: it looks up every substring in a literal rank map (an array of small
maps, so that a lookup reads one bucket by checksum), sorts those that are tokens by rank and place,
and folds them over a bit mask of the borders between bytes: a token is made where its two ends
are borders and exactly one border lies inside, which goes. That is the order in which ranked
merges happen as long as every token of the vocabulary encodes to itself (``tests`` hold the public
vocabularies to it): then a merge never makes a pair of a lower rank than its own.

Which words are folded:

1. ``frequent``: texts are cut into units (``common.units``), units are counted over all documents,
   and the most frequent are folded once, at most ``KNOWN`` of them whatever the corpus holds. That
   list, and nothing else, is sent to all tasks.
2. ``encode``: a task cuts its texts in steps of ``STEP`` bytes (one text at least). The distinct units
   of a step that are not in the list are cut into words and folded by Spark in the row of the
   step; a second task function collects the ids of every document from both.

A fold looks up about half the square of the word's length. Words over ``FOLD_BYTES`` bytes (a text without
spaces, a line of signs) are merged where they are cut, by ``Sweep``: rank after rank over
all places at once, in about 40 bytes of memory per byte of the word; words that can be cut at two
bytes which no token holds side by side are merged in parts and take less.

The classes of the pattern follow tiktoken's edition of Unicode, not that of the ``regex``
module: ``pattern`` asks tiktoken for the members of each class and names the differences.

``decode`` takes the piece of every id and concatenates them.

Defined cases: a null or empty text has no ids and decodes to no bytes; strings that look like special
tokens are ordinary text; repeated rows are encoded each; an empty table gives no rows; other
columns are ignored unless named in ``keep``; ids without a token decode to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from meterline.llm.common import byte_offsets, extended, gather, give_back, lean, plain_strings, quoted, small_batches, steps, text_or_empty, units
from meterline.workspace import materialize

# Text of one row between the tasks that cut and the fold, and of one step of the count.
STEP = 5 << 20
COUNT_STEP = 16 << 20
FOLD_BYTES = 32
# Units that every task knows.
KNOWN = 1_500_000
# Characters of a plan's text; a literal rank map is a million of them, and Spark keeps the text of every query that ran.
PLAN_TEXT = 100_000
# Buckets of the literal rank map; a lookup compares with the few tokens of one bucket.
BUCKETS = 1 << 14
# Long words are merged in parts of about this many bytes where they can be cut.
PART = 1 << 16
NEVER = np.iinfo(np.int32).max
BYTES = "ISO-8859-1"


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """The tokens of a vocabulary file with their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def pattern(source: str):
    """``source`` compiled for the ``regex`` module, its letter, number and space classes as tiktoken has them."""
    import regex
    import tiktoken

    singles = {bytes([k]): k for k in range(256)}

    def set_text(members: list[int]) -> str:
        runs = np.split(np.array(members), np.flatnonzero(np.diff(members) > 1) + 1)
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)

    for name in (r"\p{L}", r"\p{N}", r"\s"):
        encoding = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=singles, special_tokens={})
        more: list[int] = []
        fewer: list[int] = []
        # A few thousand code points at a time: every task does this once, and must stay small.
        for begin in range(0, 0x110000, 4096):
            if 0xD800 <= begin < 0xE000:
                continue
            points = "".join(map(chr, [k for k in range(begin, begin + 4096) if not 0xD800 <= k < 0xE000]))
            theirs, ours = set(encoding.decode(encoding.encode_ordinary(points))), set(regex.findall(name, points))
            more += sorted(map(ord, theirs - ours))
            fewer += sorted(map(ord, ours - theirs))
        inside = name
        if fewer:
            inside = f"[{inside}--[{set_text(fewer)}]]"
        if more:
            inside = f"[{inside}||[{set_text(more)}]]"
        source = source.replace(name, inside)
    return regex.compile(source, regex.V1)


class Sweep:
    """Ids of long words: all places of one rank are merged at once, ranks in ascending order."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        pairs = [(ranks[token[:k]] << 32 | ranks[token[k:]], rank)
                 for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pairs, self.merged = table[:, 0].copy(), table[:, 1].astype(np.int32)
        self.single = np.array([ranks[bytes([k])] for k in range(256)], np.int32)
        self.together = np.zeros(65536, bool)  # two bytes that stand side by side in a token
        for token in ranks:
            both = np.frombuffer(token, np.uint8).astype(np.int64)
            self.together[both[:-1] << 8 | both[1:]] = True

    def __call__(self, word: bytes) -> list[int]:
        if word in self.ranks:
            return [self.ranks[word]]
        data = np.frombuffer(word, np.uint8)
        apart = np.flatnonzero(~self.together[data[:-1].astype(np.int32) << 8 | data[1:]]) + 1
        picked = apart[np.searchsorted(apart, np.arange(PART, len(data), PART), side="right") - 1] if len(apart) else apart
        edges = [0, *np.unique(picked).tolist(), len(data)]
        return [x for begin, end in zip(edges, edges[1:]) for x in self._merge(data[begin:end]).tolist()]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each joined pair, ``NEVER`` where there is none."""
        wanted = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[place] == wanted, self.merged[place], NEVER).astype(np.int32)

    def _merge(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        # A piece is named by the place of its first byte; place n stands for the end.
        token = np.append(self.single[data], np.int32(0))
        after = np.minimum(np.arange(1, n + 2, dtype=np.int32), n)
        before = np.arange(-1, n, dtype=np.int32)
        alive = np.ones(n + 1, bool)
        rank = np.full(n + 1, NEVER, np.int32)
        rank[:max(n - 1, 0)] = self._ranks(token[:max(n - 1, 0)], token[1:n])
        waiting: dict[int, list[np.ndarray]] = {}
        agenda: list[int] = []

        def note(places: np.ndarray) -> None:
            places = places[rank[places] != NEVER]
            places = places[np.argsort(rank[places], kind="stable")]
            for group in np.split(places, np.flatnonzero(np.diff(rank[places])) + 1):
                if len(group):
                    r = int(rank[group[0]])
                    if r not in waiting:
                        waiting[r] = []
                        heapq.heappush(agenda, r)
                    waiting[r].append(group.astype(np.int32))

        def pair_ranks(places: np.ndarray) -> np.ndarray:
            follows = after[places]
            return np.where(follows < n, self._ranks(token[places], token[np.minimum(follows, n - 1)]), NEVER).astype(np.int32)

        note(np.arange(n - 1))
        while agenda:
            r = heapq.heappop(agenda)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[alive[places] & (rank[places] == r)]
            if not len(places):
                continue
            # In a chain of pairs that overlap, every other one is merged, from the left.
            begins = np.concatenate([[True], after[places[:-1]] != places[1:]])
            index = np.arange(len(places))
            chosen = places[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0]
            # The leftmost merge may make a pair that goes first: then it is merged alone.
            follows = after[after[chosen]]
            left, whole = before[chosen], np.full(len(chosen), r, np.int32)
            made = [np.where(follows < n, self._ranks(whole, token[np.minimum(follows, n - 1)]), NEVER),
                    np.where(left >= 0, self._ranks(token[np.maximum(left, 0)], whole), NEVER), self._ranks(whole[:1], whole[:1])]
            if min(int(x.min()) for x in made) <= r:
                chosen, rest = chosen[:1], places[1:]
                if len(rest):
                    waiting[r] = [rest]
                    heapq.heappush(agenda, r)
            gone = after[chosen]
            follows = after[gone]
            token[chosen], alive[gone], rank[gone], after[chosen] = r, False, NEVER, follows
            before[follows] = chosen
            changed = np.concatenate([chosen, before[chosen]])
            changed = np.unique(changed[changed >= 0])
            rank[changed] = pair_ranks(changed)
            note(changed)
        return token[:n][alive[:n]]


@lru_cache(maxsize=2)
def sweep(path: str) -> Sweep:
    return Sweep(ranks_of(path))


class Known:
    """Frequent units and their ids, as the tasks hold them."""

    def __init__(self, texts: pa.Array, ids: pa.ListArray) -> None:
        self.texts, self.ids = texts, ids


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text", COUNT_STEP):
            pieces, _ = units(plain_strings(step.column(0)), marks=True)
            n = np.bincount(pieces.indices.to_numpy(), minlength=len(pieces.dictionary))
            texts = pieces.dictionary
            for begin in range(0, len(texts), 1 << 16):
                yield pa.RecordBatch.from_arrays([texts[begin:begin + (1 << 16)].cast(pa.string()), pa.array(n[begin:begin + (1 << 16)])], names=["unit", "n"])


def _words(path: str, split: str, units_of_words: list[str]) -> list[list[dict]]:
    """The words of each unit: the bytes of those that Spark folds, the ids of the long ones."""
    find = pattern(split).findall

    def word(text: str) -> dict:
        data = text.encode()
        if len(data) <= FOLD_BYTES:
            return {"bytes": data.decode(BYTES), "ids": None}
        return {"bytes": None, "ids": sweep(path)(data)}

    return [[word(text) for text in find(unit)] for unit in units_of_words]


_WORDS = pa.list_(pa.struct([("bytes", pa.string()), ("ids", pa.list_(pa.int32()))]))


def _cut_known(path: str, split: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_words(path, split, batch.column(0).to_pylist()), _WORDS)], names=["unit", "words"])

    return cut


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: ``BUCKETS`` maps, a token in the bucket of its checksum."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        text = token.decode(BYTES)
        buckets[zlib.crc32(text.encode()) % BUCKETS][text] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def merge(word: Column, ranks: Column) -> Column:
    """The ids of one word of 1 to 61 bytes; ``ranks`` is what ``rank_map`` gives."""
    n = F.length(word)

    def rank(begin: Column, end: Column) -> Column:
        token = F.substring(word, begin + 1, end - begin)
        return F.try_element_at(F.get(ranks, (F.crc32(token) % BUCKETS).cast("int")), token)

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    # A token is one number: its rank, then where it begins and ends, 6 bits each.
    found = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda begin: F.transform(
        F.sequence(begin + 2, n), lambda end: rank(begin, end) * F.lit(4096).cast("long") + begin * 64 + end)))
    ranked = F.array_sort(F.array_compact(found))

    def turn(borders: Column, token: Column) -> Column:
        ends = bit(token.bitwiseAND(63).cast("int")), bit(F.shiftright(token, 6).bitwiseAND(63).cast("int"))
        inside = borders.bitwiseAND(ends[0] - ends[1] - ends[1])
        return F.when(
            (borders.bitwiseAND(ends[0]) != 0) & (borders.bitwiseAND(ends[1]) != 0),
            bound(inside, lambda inner: F.when(inner.bitwiseAND(inner - 1) == 0, borders - inner).otherwise(borders)),
        ).otherwise(borders)

    left = F.aggregate(ranked, bit(n + 1) - 1, turn)
    places = bound(left, lambda borders: F.filter(F.sequence(F.lit(0), n), lambda k: borders.bitwiseAND(bit(k)) != 0))
    pieces = bound(places, lambda at: F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda k: rank(F.get(at, k - 1), F.get(at, k))))
    return F.when(n == 1, F.array(rank(F.lit(0), n))).otherwise(pieces)


def fold(words: Column, ranks: Column) -> Column:
    """The ids of a unit from its words."""
    return F.flatten(F.transform(
        words, lambda word: F.when(word["ids"].isNotNull(), word["ids"]).otherwise(merge(word["bytes"], ranks))))


def frequent(docs: DataFrame, path: str, split: str, most: int = KNOWN) -> DataFrame:
    """The most frequent units of all texts, ``most`` at most, and their ids; stored."""
    texts = small_batches(docs.select(text_or_empty("text").alias("text")))
    counted = materialize(texts.mapInArrow(lean(_count), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")), "byte-pairs-units")
    # A row per count up to 1,000: how many units have it, the more frequent ones together.
    shares = counted.groupBy(F.least("n", F.lit(1000)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, taken = 1001, 0
    for n, units_with in shares:
        if taken + units_with > most:
            break
        least, taken = n, taken + units_with
    chosen = counted.filter(F.col("n") >= least) if least <= 1000 else counted.orderBy(F.desc("n"), "unit").limit(most)
    words = chosen.filter(F.octet_length("unit") <= FOLD_BYTES).select("unit").mapInArrow(
        lean(_cut_known(path, split)), "unit string, words array<struct<bytes string, ids array<int>>>")
    return materialize(words.select("unit", bound(rank_map(ranks_of(path)), lambda ranks: fold(F.col("words"), ranks)).alias("ids")), "byte-pairs-known")


def _cut(path: str, split: str, n_keep: int, known: Broadcast, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text", STEP):
                pieces, first = units(plain_strings(step.column(n_keep)), marks=True)
                place = pc.index_in(pieces.dictionary, value_set=known.value.texts)
                new = pieces.dictionary.filter(pc.is_null(place)).to_pylist()
                # Numbers of units: those of the list first, then the new ones of the step.
                number = pc.fill_null(place, 0).to_numpy().astype(np.int32)
                number[pc.is_null(place).to_numpy(zero_copy_only=False)] = len(known.value.texts) + np.arange(len(new), dtype=np.int32)
                codes = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(number[pieces.indices.to_numpy()]))
                docs = pa.StructArray.from_arrays([*step.columns[:n_keep], codes], fields=list(schema.field(0).type.value_type))
                words = pa.array(_words(path, split, new), _WORDS).cast(schema.field(1).type.value_type)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                ], schema=schema)

    return cut


def _assemble(n_keep: int, known: Broadcast):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, new = batch.column(0)[row].values, batch.column(1)[row].values
                lists = pa.concat_arrays([known.value.ids, new.cast(known.value.ids.type)])
                codes = docs.field(n_keep)
                ids, lengths = gather(lists, codes.flatten())
                ends = np.concatenate([[0], np.cumsum(lengths)])
                units_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy(zero_copy_only=False))]).astype(np.int64)
                whole = pa.LargeListArray.from_arrays(pa.array(ends[units_ends]), pa.array(ids, pa.int32()))
                kept = [docs.field(k) for k in range(n_keep)]
                for begin in range(0, len(docs), 512):
                    part = whole[begin:begin + 512]
                    yield pa.RecordBatch.from_arrays(
                        [*(x[begin:begin + 512] for x in kept), part.cast(pa.list_(pa.int32()))], names=[*(f"k{k}" for k in range(n_keep)), "ids"])

    return assemble


def encode(docs: DataFrame, path: str, split: str, keep: Sequence[str] = ("doc_id",), most: int = KNOWN) -> DataFrame:
    """The columns ``keep`` of every document and ``ids`` (array of int) of its whole text.

    ``path`` names the vocabulary file on every machine, ``split`` is the pattern that cuts words.
    """
    conf = docs.sparkSession.conf
    conf.set("spark.sql.maxPlanStringLength", str(min(int(str(conf.get("spark.sql.maxPlanStringLength")).rstrip("b")), PLAN_TEXT)))
    listed = frequent(docs, path, split, most).toArrow()
    known = docs.sparkSession.sparkContext.broadcast(Known(
        plain_strings(listed["unit"]), pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *(x.cast(pa.list_(pa.int32())) for x in listed["ids"].chunks)])))
    del listed
    give_back()
    rows = docs.select(*(F.col(quoted(name)).alias(f"k{k}") for k, name in enumerate(keep)), text_or_empty("text").alias("text"))
    kept = T.StructType(rows.schema.fields[:-1])
    of_step = T.StructType([
        T.StructField("docs", T.ArrayType(T.StructType([*kept.fields, T.StructField("codes", T.ArrayType(T.IntegerType()))]))),
        T.StructField("words", T.ArrayType(T.ArrayType(T.StructType.fromDDL("bytes string, ids array<int>")))),
    ])
    cut = small_batches(rows).mapInArrow(lean(_cut(path, split, len(keep), known, to_arrow_schema(of_step))), of_step)
    folded = cut.select("docs", bound(rank_map(ranks_of(path)), lambda ranks: F.transform("words", lambda words: fold(words, ranks))).alias("ids"))
    ids = folded.mapInArrow(lean(_assemble(len(keep), known)), T.StructType([*kept.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return ids.select(*(F.col(f"k{k}").alias(name) for k, name in enumerate(keep)), "ids")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> pa.Array:
    """The bytes of every id, and no bytes in the last place."""
    ranks = ranks_of(path)
    pieces = [b""] * (max(ranks.values(), default=-1) + 2)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pa.array(pieces, pa.large_binary())


def decode_lists(lists: pa.Array, path: str) -> pa.Array:
    """The bytes of each list of ids."""
    pieces = pieces_of(path)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    ids = np.where((ids >= 0) & (ids < len(pieces) - 1), ids, len(pieces) - 1)
    found = pieces.take(pa.array(ids))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    offsets = byte_offsets(found)[ends] if len(found) else np.zeros(len(lists) + 1, np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(offsets)), found.buffers()[2]])


def _few(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lists hold about ``size`` ids each; the lists are the last column."""
    ends = np.cumsum(pc.list_value_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded`` (binary) in place of ``ids``."""
    rows = encoded.select(*(quoted(name) for name in encoded.columns if name != "ids"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _few(batch):
                lists = part.column(part.num_columns - 1)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], decode_lists(lists, path).cast(pa.binary())], names=[*part.schema.names[:-1], "decoded"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "decoded binary"))


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the checksums of the ids (little-endian, 32 bits) and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _few(batch):
                lists = part.column(1)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(lengths)
                texts = decode_lists(lists, path)
                at, data = byte_offsets(texts), memoryview(texts.buffers()[2] or b"")
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(lengths),
                    pa.array([hashlib.sha256(ids[end - n:end]).hexdigest() for n, end in zip(lengths, ends)], pa.string()),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = encoded.select("doc_id", "ids")
    return small_batches(rows).mapInArrow(lean(run), extended(rows, "n_tokens long, ids_sha256 string, decoded_sha256 string"))
