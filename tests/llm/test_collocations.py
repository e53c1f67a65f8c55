from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterline.llm import collocations as c

LOWER = {k: k + 32 for k in range(0x41, 0x5B)}
SCHEMA = "lang string, text string"


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute_force(rows, least=30, most=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[k:k + n]) for k in range(len(words) - n + 1))
    candidates = {key: a for key, a in counts.items() if len(key) > 2 and a >= least}
    inside = Counter()
    for (lang, *words), a in candidates.items():
        for n in range(2, len(words)):
            for k in range(len(words) - n + 1):
                part = (lang, *words[k:k + n])
                inside[part] = max(inside[part], a)
    result = []
    for lang in totals:
        found = []
        for (own, *words), a in candidates.items():
            if own != lang or 100 * inside[(lang, *words)] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[(lang, *words[:k])] + counts[(lang, *words[k:])]), k,
                                  counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words)))
            found.append((-score, -a, " ".join(words).encode(), a, l, r))
        result += [(lang, rank, phrase.decode(), a, l, r, totals[lang], -score) for rank, (score, _, phrase, a, l, r) in enumerate(sorted(found)[:most], 1)]
    return sorted(result)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "ÄÖ", "中文", "a\x00b", "x'y", "#", "rare" , "New", "York", "City", "Hall", "in", "on"]
    gaps = [" ", "  ", "\t", " \t", ". ", ",", "\n", "\x0b", "; "]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.randrange(1, 40)):
            text += "New York City Hall" if rnd.random() < 0.1 else rnd.choice(words)
            text += rnd.choices(gaps, [20, 2, 2, 1, 2, 1, 1, 1, 1])[0]
        rows.append((rnd.choice(["en", "en", "de", None]), text))
    return rows + [("en", None), ("en", ""), ("", "a b"), ("und", "New York"), ("xx", " .,\n")]


def run(spark, rows, **options):
    got = c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def test_brute_force(spark, monkeypatch):
    rows = corpus(400, 1)
    want = brute_force(rows)
    assert len(want) >= 30 and run(spark, rows) == want
    assert run(spark, rows, most=7) == brute_force(rows, most=7)
    monkeypatch.setattr(c, "STEP", 500)
    assert run(spark, rows, least=3, most=50) == brute_force(rows, 3, 50)


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    """Fingerprints so short that most phrases collide, and a filter that is full."""
    exact = c.Grams.fingerprints
    monkeypatch.setattr(c.Grams, "fingerprints", lambda self, n, at: exact(self, n, at) & 63)
    rows = corpus(150, 2)
    grams = c.Grams(pa.array([text or "" for _, text in rows], pa.large_string()), [lang or "und" for lang, _ in rows])
    flags = np.full(1024, 255, np.uint8)

    class Sent:
        value = flags

    monkeypatch.setattr(c, "_steps", lambda batches: iter(batches))
    found, totals = Counter(), Counter()
    for batch in c._phrases(Sent)([grams]):
        for lang, n, phrase, times in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if n == 0:
                totals[lang] += times
                continue
            assert len(phrase.split(" ")) == n and (lang, phrase) not in found
            found[(lang, phrase)] += times
    want = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for n in range(1, 5):
                want.update((lang or "und", " ".join(words[k:k + n])) for k in range(len(words) - n + 1))
    assert found == want
    assert totals == Counter(lang or "und" for lang, text in rows for words in pieces(text) for _ in words)


def test_prefix_sums_over_chunks(monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 16)
    polynomial = c.Polynomial(c.BASE)
    data = np.frombuffer(b"some bytes that repeat: some bytes that repeat: some bytes", np.uint8)
    places = np.array([0, 10, 24, 34, 48, 58])
    assert len(data) == 58
    sums, shifts = polynomial.prefixes(data, places), polynomial.shifts(places)
    hashes = {int((sums[k + 1] - sums[k]) * shifts[k]) for k in (0, 2, 4)}
    assert hashes == {sum(int(c.BYTES[byte]) * pow(c.BASE, k, 2**64) for k, byte in enumerate(b"some bytes")) % 2**64}


def test_one_long_text_and_no_text(spark, edge_docs, no_docs):
    assert c.collocations(no_docs).count() == 0
    long = " ".join(["alpha beta gamma delta"] * 5000)
    assert run(spark, [("en", long)]) == brute_force([("en", long)])
    rows = [(row.lang, row.text) for row in edge_docs.collect()]
    assert sorted(map(tuple, c.collocations(edge_docs, least=2).collect())) == brute_force(rows, 2)


@pytest.mark.parametrize("a, l, r", [(10**13, 10**13, 10**13), (2**62, 2**62, 2**62 + 5)])
def test_exact_beyond_64_bits(spark, a, l, r):
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(
        "cast(a as decimal(28,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as score").first()
    assert row.score == 2_000_000 * a // (l + r)
