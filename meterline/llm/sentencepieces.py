"""SentencePiece encoding and decoding of merge-type vocabularies.

A text starts as single characters. The agenda holds the adjacent pairs of symbols whose
concatenation is a piece; the pair with the highest score, the leftmost of equals, is merged and
its new neighbours enter the agenda, until it is empty. Characters without a piece become byte
pieces. Vocabularies must be of the kind this covers: byte-pair type with byte fallback, no
normalisation rules, a space put before the text, white space kept, no user-defined pieces, and
no piece with a space behind another character. The constructor checks that.

Because of the last condition no merge reaches over a space that follows another character, so
each distinct word of an Arrow batch is encoded once: short ones all at once as numpy arrays, one
merge of each word per round, long ones with a heap. The ids of every distinct word of every
batch are then compared with the sentencepiece library's, and a difference is an error. Ids are
decoded by the library itself.

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows and
null ids are rows like any other; other columns are not read; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import extended, lean, plain_strings, small_batches, steps, text_or_empty, units

SPACE = "▁"
# Words of more characters than this use the heap.
ROUND_CHARACTERS = 48
# Text per step of a task, and ids that become Python numbers at once for the library's decoder.
STEP = 6 << 20
DECODED_IDS = 1 << 18
# Distinct words whose checked ids a Python worker remembers; others are encoded again.
REMEMBERED_WORDS = 200_000


class PieceModel:
    """The pieces of a model file, prepared for merging."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as protocol

        with open(path, "rb") as file:
            blob = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        model = protocol.ModelProto()
        model.ParseFromString(blob)
        kinds = protocol.ModelProto.SentencePiece
        spec, normal = model.trainer_spec, model.normalizer_spec
        if not (spec.model_type == spec.BPE and spec.byte_fallback and normal.add_dummy_prefix
                and not normal.remove_extra_whitespaces and normal.escape_whitespaces
                and not normal.precompiled_charsmap and not spec.treat_whitespace_as_suffix):
            raise ValueError(f"{path}: not a byte-pair vocabulary without normalisation")
        pieces = [(k, p.piece, p.score) for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: user-defined or unused pieces are not covered")
        if any(SPACE in piece.lstrip(SPACE) for _, piece, _ in pieces):
            raise ValueError(f"{path}: a piece holds a space behind another character")
        self.ids = {piece: k for k, piece, _ in pieces}
        self.byte_ids = np.array([self.library.piece_to_id(f"<0x{value:02X}>") for value in range(256)], np.int32)
        self.score = np.full(len(model.pieces), -np.inf)
        for k, _, score in pieces:
            self.score[k] = score
        # Rank 0 is the best score; equal scores share a rank.
        levels = np.unique(-self.score)
        self.rank = np.searchsorted(levels, -self.score).astype(np.int64)
        # (left, right) -> merged: every way to cut a piece into two symbols. A symbol is a piece
        # or a single character without one, which no piece contains.
        size = len(model.pieces)
        merges = {}
        for k, piece, _ in pieces:
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    merges[left * size + right] = k
        self.size = size
        self.merged = merges
        keys = np.array(sorted(merges), np.int64)
        self.pair_keys = keys
        self.pair_ids = np.array([merges[key] for key in keys.tolist()], np.int64)
        # Characters that pieces hold must be pieces for the cut above to be complete.
        if any(character not in self.ids for _, piece, _ in pieces for character in piece):
            raise ValueError(f"{path}: a piece holds a character without a piece")
        points = sorted((ord(piece), k) for piece, k in self.ids.items() if len(piece) == 1)
        self.points = np.array([p for p, _ in points], np.int64)
        self.point_ids = np.array([k for _, k in points], np.int64)
        self.known: dict[str, bytes] = {}

    # One word ------------------------------------------------------------------------------

    def encode_word(self, word: str) -> list[int]:
        """Ids of one normalised word (spaces as the space symbol), with a heap as the agenda."""
        n = len(word)
        symbol = [self.ids.get(character, -1) for character in word]
        begin, end = list(range(n)), list(range(1, n + 1))
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        size, merged, rank = self.size, self.merged, self.rank
        agenda: list[tuple[int, int, int, int, int]] = []

        def pair(a: int, b: int) -> tuple[int, int, int, int, int] | None:
            if symbol[a] < 0 or symbol[b] < 0:
                return None
            new = merged.get(symbol[a] * size + symbol[b])
            return None if new is None else (int(rank[new]), a, b, new, end[b])

        agenda = [entry for k in range(n - 1) if (entry := pair(k, k + 1))]
        heapify(agenda)
        alive = [True] * n
        while agenda:
            _, a, b, new, stop = heappop(agenda)
            # An entry is stale if either symbol has been merged since.
            if not (alive[a] and alive[b]) or right[a] != b or end[b] != stop or merged.get(symbol[a] * size + symbol[b]) != new:
                continue
            symbol[a], end[a], alive[b] = new, end[b], False
            right[a] = right[b]
            if right[a] >= 0:
                left[right[a]] = a
                if entry := pair(a, right[a]):
                    heappush(agenda, entry)
            if left[a] >= 0 and (entry := pair(left[a], a)):
                heappush(agenda, entry)
        ids: list[int] = []
        for k in range(n):
            if alive[k]:
                if symbol[k] >= 0:
                    ids.append(symbol[k])
                else:
                    ids.extend(self.byte_ids[list(word[begin[k]:end[k]].encode())].tolist())
        return ids

    # Many words ----------------------------------------------------------------------------

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged piece of each pair, or -1."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_keys[at] == keys), self.pair_ids[at], -1)

    def encode_short(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row and the number of ids of each; all agendas advance together.

        Words are rows of a matrix, padded on the right. Each round merges the best pair of every
        row that still has one and closes the gap, so rounds are bounded by the longest word.
        """
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        # Characters without a piece are kept as -2 - code point.
        flat = np.where(self.points[at] == points, self.point_ids[at], -2 - points)
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths)
        parts, counts = [], np.zeros(n, np.int64)
        worst = np.iinfo(np.int64).max
        for begin in range(0, n, 1 << 14):
            rows = order[begin:begin + (1 << 14)]
            width = int(lengths[rows[0]]) if len(rows) else 0
            count = lengths[rows].copy()
            column = np.arange(width)
            filled = column < count[:, None]
            symbols = np.full((len(rows), width), -1, np.int64)
            source = (ends - lengths)[rows][:, None] + column
            symbols[filled] = flat[source[filled]]
            live = np.flatnonzero(count > 1)
            if width > 1:
                new = self._merge_of(symbols[:, :-1], symbols[:, 1:])
                cost = np.where(new >= 0, self.rank[new], worst)
            while len(live):
                best = cost[live].argmin(axis=1)  # the first of equals is the leftmost
                ok = cost[live, best] < worst
                live, best = live[ok], best[ok]
                if not len(live):
                    break
                symbols[live, best] = new[live, best]
                # Close the gap behind the merged symbol, then look at its two new pairs.
                shift = np.arange(width - 1)
                moved = np.where(shift > best[:, None], shift + 1, shift)
                moved = np.minimum(moved, width - 1)
                tail = np.full((len(live), 1), -1, np.int64)
                symbols[live] = np.concatenate([np.take_along_axis(symbols[live], moved, 1), tail], axis=1)
                count[live] -= 1
                pairs = np.where(shift >= best[:, None], np.minimum(shift + 1, width - 2), shift)
                here_new, here_cost = np.take_along_axis(new[live], pairs, 1), np.take_along_axis(cost[live], pairs, 1)
                here_new[:, -1], here_cost[:, -1] = -1, worst
                for place in (best - 1, best):
                    inside = (place >= 0) & (place < width - 1)
                    r, c = np.flatnonzero(inside), place[inside]
                    fresh = self._merge_of(symbols[live[r], c], symbols[live[r], c + 1])
                    here_new[r, c], here_cost[r, c] = fresh, np.where(fresh >= 0, self.rank[fresh], worst)
                new[live], cost[live] = here_new, here_cost
            parts.append(symbols[column < count[:, None]])
            counts[rows] = count
        # Back from the order of length to the order of the words.
        sizes = counts[order]
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate(parts) if n else np.empty(0, np.int64)))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        return self._with_bytes(lists.take(pa.array(place)).flatten().to_numpy(zero_copy_only=False), counts)

    def _with_bytes(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece (-2 - code point) by their byte pieces."""
        strange = np.flatnonzero(ids < -1)
        if not len(strange):
            return ids, counts
        byte_lists = [self.byte_ids[list(chr(-2 - int(ids[k])).encode())] for k in strange]
        extra = np.array([len(x) - 1 for x in byte_lists], np.int64)
        ends = np.cumsum(counts)
        word = np.searchsorted(ends, strange, side="right")
        counts = counts + np.bincount(word, extra, len(counts)).astype(np.int64)
        parts, last = [], 0
        for k, new in zip(strange.tolist(), byte_lists):
            parts += [ids[last:k], new]
            last = k + 1
        return np.concatenate([*parts, ids[last:]]).astype(np.int64), counts

    def encode_words(self, words: list[str]) -> pa.ListArray:
        """Ids of each word as it stands in a text (a leading space, spaces not yet replaced)."""
        normal = [word.replace(" ", SPACE) for word in words]
        short = [k for k, word in enumerate(normal) if len(word) <= ROUND_CHARACTERS]
        flat, counts = self.encode_short([normal[k] for k in short])
        if len(short) < len(normal):
            # The few long words go between the short ones.
            pieces = dict(zip(short, np.split(flat, np.cumsum(counts)[:-1])))
            lists = [pieces[k] if k in pieces else np.array(self.encode_word(word), np.int64) for k, word in enumerate(normal)]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.concatenate(lists) if lists else flat
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    def check_words(self, words: list[str], lists: pa.ListArray) -> None:
        """Compare with the library, which puts the leading space back itself."""
        offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        for begin in range(0, len(words), 1 << 14):
            part = words[begin:begin + (1 << 14)]
            # A word that is one space alone is empty to the library.
            expected = self.library.encode([word[1:] for word in part], num_threads=1)
            sizes = np.fromiter(map(len, expected), np.int64, len(expected))
            own = np.diff(offsets[begin:begin + len(part) + 1])
            lone = np.fromiter((word == " " for word in part), bool, len(part))
            if not (np.array_equal(sizes[~lone], own[~lone])
                    and np.array_equal(np.array(list(chain.from_iterable(expected)), np.int32),
                                       flat[offsets[begin]:offsets[begin + len(part)]][np.repeat(~lone, own)])):
                raise AssertionError("ids differ from the sentencepiece library's")

    def word_lists(self, words: list[str]) -> pa.ListArray:
        """Checked ids of each word; a bounded number of words is remembered between batches."""
        known = self.known
        found = [known.get(word) for word in words]
        new = [k for k, ids in enumerate(found) if ids is None]
        unseen = [words[k] for k in new]
        lists = self.encode_words(unseen)
        self.check_words(unseen, lists)
        blob, ends = np.asarray(lists.values).tobytes(), (4 * np.asarray(lists.offsets)).tolist()
        for n, k in enumerate(new):
            ids = found[k] = blob[ends[n]:ends[n + 1]]
            if len(known) < REMEMBERED_WORDS and len(ids) < 256:
                known[words[k]] = ids
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text; ``texts`` holds no nulls."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        empty = np.asarray(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        pieces, first = units(spaced.filter(pa.array(~empty)))
        taken = self.word_lists(pieces.dictionary.to_pylist()).take(pieces.indices)
        ends = np.asarray(taken.offsets)[first] if len(first) > 1 else np.zeros(1, np.int32)
        counts = np.zeros(len(texts), np.int64)
        counts[~empty] = np.diff(ends)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), taken.flatten())

    def decode(self, lists: pa.ListArray) -> list[str]:
        """The library's decoding of each list of ids."""
        ends, ids = np.asarray(lists.offsets), np.asarray(lists.values)
        texts: list[str] = []
        while len(texts) < len(lists):
            begin = len(texts)
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + DECODED_IDS, side="right")) - 1)
            numbers, at = ids[ends[begin]:ends[end]].tolist(), (ends[begin:end + 1] - ends[begin]).tolist()
            texts += self.library.decode([numbers[a:b] for a, b in zip(at, at[1:])], num_threads=1)
        return texts


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, ``ids`` and ``decoded`` (of the ids) of each row."""
    rows = docs.select(*(F.col(name) for name in keep), text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            for step in steps(batch, "_text", STEP):
                ids = pieces.encode(plain_strings(step.column(step.num_columns - 1)))
                yield pa.RecordBatch.from_arrays(
                    [*step.columns[:-1], ids, pa.array(pieces.decode(ids), pa.string())], names=[*step.schema.names[:-1], "ids", "decoded"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "ids array<int>, decoded string"))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
