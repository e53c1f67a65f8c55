r"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), split at ``[.,;:!?\x0A-\x0D]`` into pieces and these into words
``[^\x20\x09]+``; everything is counted per language. The words of a step (``STEP`` bytes, one text at least)
are written in a row with one space between them, and the prefix sums of a polynomial modulo 2^64 give
the fingerprint of any run of words by one subtraction and one product; the language is mixed in. A
phrase lies inside one piece.

1. For words, then pairs, then runs of 3 and 4 words, every n-gram is hashed, each step sends its distinct
   fingerprints with their counts, and Spark adds them up. Those counted ``least`` times or more go into a filter, a
   bitmap of ``FILTER_BITS`` bits whatever the corpus holds, which all tasks get. Of pairs, a task sends
   only those whose words are in the filter, of longer runs only those whose pairs are: a
   phrase is never more frequent than its parts, so this loses none. A full filter only lets more through.
2. ``verified``: n-grams in the filter are looked up in the text. A step keeps a pointer to the first place
   of each fingerprint and compares the bytes of every other place with it; places that differ are
   kept apart. Then the steps meet on the phrases themselves, not on fingerprints, and phrases counted
   ``least`` times or more are stored: a collision costs work and changes no count.
3. ``collocations``: candidates are cut at every word and scored by joins on the stored phrases.
   A score is a quotient of decimals with 38 digits.

Defined cases: a null text has no words; a null language is ``und``; repeated rows count each; fewer
words than a phrase needs give none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.common import lean, plain_strings, small_batches, steps, text_bytes, text_or_empty
from meterline.workspace import materialize, tidy

MOST_WORDS = 4
# What each pass over the texts counts, and the size of the runs that must be frequent for it.
ROUNDS = (((1,), 0), ((2,), 1), ((3, 4), 2))
# Text of one step; what a step holds grows with it, or with the longest text.
STEP = 4 << 20
# Bytes whose prefix sums are made at once.
CHUNK = 1 << 18
# A power of two.
FILTER_BITS = 1 << 26
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
# Lower case for A-Z, a space for what separates words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[0x41:0x5B] += 0x20
_PLAIN[_GAP] = 0x20


# What a byte stands for in the polynomial, a fixed 64-bit number each, and the base; odd, so that it can be divided by.
BYTES = np.array([xxhash.xxh64_intdigest(bytes([k])) for k in range(256)], np.uint64)
BASE = 0x9E3779B97F4A7C15
_WRAP = 1 << 64


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), _WRAP))])
    return found[:n]


class Polynomial:
    """Prefix sums of a polynomial modulo 2^64; the hash of a range does not depend on where it lies."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, _WRAP)
        self.up, self.down = powers(base, CHUNK), powers(self.inverse, CHUNK)

    def prefixes(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The sum over all bytes before each of the ascending ``places``."""
        found = np.zeros(len(places), np.uint64)
        total = np.zeros(1, np.uint64)
        for begin in range(0, len(data), CHUNK):
            part = BYTES[data[begin:begin + CHUNK]]
            part *= self.up[:len(part)]
            sums = np.cumsum(part, dtype=np.uint64)
            factor = np.uint64(pow(self.base, begin, _WRAP))
            low, high = np.searchsorted(places, [begin + 1, begin + len(part) + 1])
            found[low:high] = total + sums[places[low:high] - begin - 1] * factor
            total = total + sums[-1:] * factor
        return found

    def shifts(self, places: np.ndarray) -> np.ndarray:
        """What moves the sum of a range that begins at each place to place 0."""
        whole, rest = np.divmod(places, CHUNK)
        coarse = powers(pow(self.inverse, CHUNK, _WRAP), int(whole.max(initial=0)) + 1)
        return self.down[rest] * coarse[whole]


class Grams:
    """The words of some texts, and the fingerprints of their n-grams."""

    def __init__(self, texts: pa.Array, langs: list[str]) -> None:
        # A line end after each text ends its last piece.
        data, offsets = text_bytes(pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())))
        gap = _GAP[data]
        kept = ~gap
        begins = kept.copy()
        begins[1:] &= gap[:-1]
        starts = np.flatnonzero(begins)
        self.piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts]
        # One space after every word: the byte that follows it.
        kept[1:] |= ~gap[:-1]
        self.data = _PLAIN[data[kept]]
        self.end = np.flatnonzero(self.data == 0x20)
        self.begin = np.concatenate([[0], self.end[:-1] + 1]).astype(np.int64) if len(self.end) else self.end
        self.text = np.searchsorted(offsets, starts, side="right") - 1
        self.langs, code = np.unique(np.array(langs, object), return_inverse=True) if langs else (np.array([], object), np.zeros(0, np.int64))
        self.lang = code[self.text]
        self.seed = np.array([xxhash.xxh64_intdigest(lang) for lang in self.langs], np.uint64)
        polynomial = _polynomial()
        self.before, self.after = polynomial.prefixes(self.data, self.begin), polynomial.prefixes(self.data, self.end)
        self.shift = polynomial.shifts(self.begin)

    def whole(self, n: int) -> np.ndarray:
        """Which words begin an n-gram inside one piece."""
        count = max(len(self.begin) - n + 1, 0)
        return self.piece[:count] == self.piece[n - 1:n - 1 + count]

    def fingerprints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams that begin at the words ``at``; the lowest two bits are n - 1."""
        found = (self.after[at + n - 1] - self.before[at]) * self.shift[at] + self.seed[self.lang[at]]
        # The low bits of such a sum are the weak ones: spread the high ones over them.
        found ^= found >> np.uint64(31)
        found *= np.uint64(BASE)
        found ^= found >> np.uint64(29)
        return ((found & ~np.uint64(3)) | np.uint64(n - 1)).view(np.int64)


@lru_cache(maxsize=1)
def _polynomial() -> Polynomial:
    return Polynomial(BASE)


def _places(fingerprints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that stand for each fingerprint."""
    mixed, last = fingerprints.view(np.uint64) * np.uint64(BASE), np.uint64(bits - 1)
    return (mixed >> np.uint64(8)) & last, (mixed >> np.uint64(36)) & last


def in_filter(flags: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    """Which fingerprints may be in the filter; those that were put in always are."""
    found = np.ones(len(fingerprints), bool)
    for place in _places(fingerprints, len(flags) * 8):
        found &= (flags[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def _passing(grams: Grams, n: int, part: int, flags: np.ndarray | None) -> np.ndarray:
    """The words that begin an n-gram all of whose runs of ``part`` words are in the filter."""
    at = np.flatnonzero(grams.whole(n))
    if flags is None or not len(at):
        return at
    wanted = np.zeros(len(grams.begin), bool)
    for k in range(n - part + 1):
        wanted[at + k] = True
    touched = np.flatnonzero(wanted)
    wanted[touched] = in_filter(flags, grams.fingerprints(part, touched))
    for k in range(n - part + 1):
        at = at[wanted[at + k]]
    return at


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for batch in batches:
        for step in steps(batch, "text", STEP):
            yield Grams(plain_strings(step.column(1)), step.column(0).to_pylist())


def _count(sizes: tuple[int, ...], part: int, flags: Broadcast | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _steps(batches):
            for n in sizes:
                found, times = np.unique(grams.fingerprints(n, _passing(grams, n, part, flags and flags.value)), return_counts=True)
                for begin in range(0, len(found), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(found[begin:begin + (1 << 18)]), pa.array(times[begin:begin + (1 << 18)])], names=["fingerprint", "n"])

    return count


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.concatenate(_places(batch.column(0).to_numpy(), FILTER_BITS)).astype(np.int64)
        word, first = np.unique(places >> 5, return_inverse=True)
        value = np.zeros(len(word), np.int64)
        np.bitwise_or.at(value, first, np.int64(1) << (places & 31))
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], names=["word", "value"])


def frequent_filter(counted: DataFrame, flags: np.ndarray) -> np.ndarray:
    """``flags`` with the fingerprints of ``counted`` (one column, long) put in; the driver gets ``FILTER_BITS`` bits at most."""
    words = small_batches(counted).mapInArrow(lean(_bits), "word long, value long").groupBy("word").agg(F.expr("bit_or(value)").alias("value")).toArrow()
    whole = flags.view("<u4").copy()
    whole[words["word"].to_numpy()] |= words["value"].to_numpy().astype("<u4")
    return whole.view(np.uint8)


def _phrases(flags: Broadcast):
    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _steps(batches):
            totals = np.bincount(grams.lang, minlength=len(grams.langs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.langs, pa.string()), pa.array(np.zeros(len(totals), np.int32)), pa.array([""] * len(totals)), pa.array(totals)],
                names=["lang", "words", "phrase", "n"])
            for n in range(1, MOST_WORDS + 1):
                at = np.flatnonzero(grams.whole(n))
                found = grams.fingerprints(n, at)
                passing = in_filter(flags.value, found)
                at, found = at[passing], found[passing]
                order = np.argsort(found, kind="stable")
                at, found = at[order], found[order]
                while len(at):
                    # The first place of a fingerprint is the pointer that its other places are held against.
                    new = np.concatenate([[True], found[1:] != found[:-1]])
                    group = np.cumsum(new) - 1
                    pointer = at[new]
                    same = _same(grams, n, at, pointer[group])
                    times = np.bincount(group[same], minlength=len(pointer))
                    for begin in range(0, len(pointer), 1 << 16):
                        part = pointer[begin:begin + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(grams.langs[grams.lang[part]], pa.string()), pa.array(np.full(len(part), n, np.int32)),
                            _texts(grams, n, part), pa.array(times[begin:begin + (1 << 16)]),
                        ], names=["lang", "words", "phrase", "n"])
                    at, found = at[~same], found[~same]  # of another phrase or language

    return phrases


def _texts(grams: Grams, n: int, at: np.ndarray) -> pa.Array:
    """The n-grams that begin at the words ``at``."""
    begins, lengths = grams.begin[at], grams.end[at + n - 1] - grams.begin[at]
    ends = np.cumsum(lengths)
    places = np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(grams.data[places])).cast(pa.string())


def _same(grams: Grams, n: int, at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the n-grams at two lists of words have the same bytes and language."""
    lengths = grams.end[at + n - 1] - grams.begin[at]
    same = (lengths == grams.end[other + n - 1] - grams.begin[other]) & (grams.lang[at] == grams.lang[other])
    for begin in range(0, len(at), 1 << 16):
        part = slice(begin, begin + (1 << 16))
        size = np.where(same[part] & (at[part] != other[part]), lengths[part], 0)
        ends = np.cumsum(size)
        inside = np.arange(ends[-1]) - np.repeat(ends - size, size)
        differ = grams.data[np.repeat(grams.begin[at[part]], size) + inside] != grams.data[np.repeat(grams.begin[other[part]], size) + inside]
        same[begin + np.repeat(np.arange(len(size)), size)[differ]] = False
    return same


def _texts_of(docs: DataFrame) -> DataFrame:
    return small_batches(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty("text").alias("text")))


def verified(docs: DataFrame, least: int = 30) -> DataFrame:
    """lang, words (1 to 4), phrase and n of every phrase found ``least`` times or more in a language; stored.

    A row with 0 words and no phrase holds the occurrences of all words of a language.
    """
    texts = _texts_of(docs)
    context = docs.sparkSession.sparkContext
    flags, sent = np.zeros(FILTER_BITS // 8, np.uint8), None
    for sizes, part in ROUNDS:
        counted = texts.mapInArrow(lean(_count(sizes, part, sent)), "fingerprint long, n long").groupBy("fingerprint").agg(F.sum("n").alias("n"))
        flags = frequent_filter(counted.filter(F.col("n") >= least).select("fingerprint"), flags)
        sent = context.broadcast(flags)
        del counted
        tidy(docs.sparkSession)
    found = texts.mapInArrow(lean(_phrases(sent)), "lang string, words int, phrase string, n long")
    return materialize(found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("words") == 0)), "phrases")


def _parts(phrase: str, begin: int | Callable, size: int | Callable):
    return F.array_join(F.slice(F.split(phrase, " ", -1), begin, size), " ")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of two to four words in each language."""
    phrases = verified(docs, least)
    totals = phrases.filter("words = 0").select("lang", F.col("n").alias("total"))
    counts = phrases.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    candidates = phrases.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    first = cuts.withColumn("part", _parts("phrase", F.lit(1), F.col("k"))).join(counts, ["lang", "part"]).withColumnRenamed("times", "l")
    both = (first.withColumn("part", _parts("phrase", F.col("k") + 1, F.col("words")))
            .join(counts, ["lang", "part"]).withColumnRenamed("times", "r"))
    scored = both.withColumn("score", F.expr("cast(a as decimal(28,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every shorter run of two words or more of a candidate, with the candidate's count.
    longer = candidates.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    within = longer.groupBy("lang", _parts("phrase", F.col("begin"), F.col("size")).alias("phrase")).agg(F.max("a").alias("inside"))
    kept = lowest.join(within, ["lang", "phrase"], "left").filter("inside is null or 100 * inside < 80 * a")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= most)
    return best.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").alias("score"))
