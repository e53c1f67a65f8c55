from __future__ import annotations

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from meterline.llm import simhash as s


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = sorted(fps)
    array = np.array(values, np.int64).view(np.uint64)
    for k, f in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[k]) <= 2):
            a, b = find(f), find(values[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_golay_lists_meet_within_two_bits():
    random.seed(2)
    words = np.array([random.getrandbits(23) for _ in range(300)], np.int64)
    lists = s.golay_indices(words)
    sizes = (lists >= 0).sum(axis=1)
    assert set(sizes.tolist()) <= {1, 6}
    for word, own in zip(words.tolist(), lists.tolist()):
        own = {x for x in own if x >= 0}
        flips = [0, *(1 << a for a in range(23)), *(1 << a | 1 << b for a in range(23) for b in range(a))]
        others = s.golay_indices(np.array([word ^ f for f in flips], np.int64))
        assert all(own & set(row) for row in others.tolist())


def test_golay_code_is_perfect():
    _, leader, _ = s.golay_tables()
    assert len(set(leader.tolist())) == 2048 and max(int(e).bit_count() for e in leader) == 3


@pytest.mark.parametrize("join_limit", [0, 3, 64, 10_000])
def test_links_and_components(spark, join_limit):
    """With limits 0 and 3 all or most links come from the exact way for hot keys."""
    random.seed(join_limit)
    fps = set()
    for _ in range(12):
        seed = random.getrandbits(64)
        fps.add(seed)
        for _ in range(25):
            f = random.choice(list(fps))
            for b in random.sample(range(64), random.choice([1, 2, 2, 3])):
                f ^= 1 << b
            fps.add(f)
    fps |= {0, 1, (1 << 64) - 1, 1 << 63}
    values = [signed(f) for f in fps]
    df = spark.createDataFrame([(f,) for f in values], "fp long")
    edges = [tuple(r) for r in s.links(df, join_limit).collect()]
    assert all((a ^ b).bit_count() <= 2 or ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges) and all(a < b for a, b in edges)
    got = {r["fp"]: r["root"] for r in s.roots(df, join_limit).collect()}
    assert got == brute_roots(values)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000), (7, 3), (3, 7)]
    got = dict(s.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(200)}}
    assert s.components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected(rows):
    fps = [signed(brute_fingerprint(r[1])) for r in rows]
    roots = brute_roots(set(fps))
    smallest = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            smallest[roots[f]] = min(smallest.get(roots[f], r[0]), r[0])
    return [(r[0], f"{f & (1 << 64) - 1:016x}", smallest.get(roots[f])) for r, f in zip(rows, fps)], [roots[f] for f in fps]


def test_every_case(edge_docs, edge_rows, no_docs, rows):
    assert rows(s.groups(edge_docs)) == sorted(expected(edge_rows)[0], key=repr)
    assert s.groups(no_docs).count() == 0 and s.representatives(no_docs).count() == 0


def test_representatives(edge_docs, edge_rows):
    kept = s.representatives(edge_docs)
    assert kept.columns == edge_docs.columns and kept.dtypes == edge_docs.dtypes
    got = kept.collect()
    _, roots = expected(edge_rows)
    assert len(got) == len(set(roots))
    first = {}
    for r, root in zip(edge_rows, roots):
        first[root] = min(first.get(root, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(first.values())


def test_copies_of_a_third_of_all_rows(spark):
    rows = [(k, "the same words in every copy of this text", "x") if k % 3 == 0 else (k, f"text number {k} has words {k * 7} and {k * 11} of its own {k}", "x") for k in range(900)]
    got = s.groups(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    assert {r["component_id"] for r in got if r["doc_id"] % 3 == 0} == {0}
