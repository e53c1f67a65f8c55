from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from meterline.llm import mixing as m


def brute_targets(sizes):
    """Share by weight, stop at the limit, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: m.WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    total = m.SHARE * sum(sizes.values())
    while True:
        left = total - sum(target[s] for s in full)
        open_ = [s for s in order if s not in full]
        for s in open_:
            target[s] = left * weight[s] / sum(weight[x] for x in open_)
        over = [s for s in open_ if target[s] > m.LIMIT * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = m.LIMIT * sizes[s]
        full |= set(over)


def brute(rows):
    docs = []
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        quality = max(m.LEAST_QUALITY, 1 - len(re.findall(r"[#*$%&|<>!]", text)) / max(size, 1))
        digest = hashlib.md5(text.encode()).hexdigest()
        u = (int(hashlib.md5(f"{'' if doc_id is None else doc_id}:{digest}".encode()).hexdigest()[:13], 16) + 1) / 2**52
        docs.append((source, -math.log(u) / quality, doc_id, size))
    sizes = Counter()
    for source, _, _, size in docs:
        sizes[source] += size
    targets, out, by = brute_targets(sizes), [], defaultdict(list)
    for d in docs:
        by[d[0]].append(d)
    for source, members in by.items():
        total = sizes[source]
        epochs = int(targets[source] / total + 1e-12) if total else 0
        rest, ahead = targets[source] - epochs * total, 0
        for _, _, doc_id, size in sorted(members, key=lambda d: d[1]):
            taken = size * (epochs + (2 * ahead + size <= 2 * rest + 1e-9))
            ahead += size
            out.append((doc_id, size, total, round(targets[source], 6), taken))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=repr)


def test_every_case(edge_docs, edge_rows, no_docs):
    assert result(m.mix(edge_docs)) == brute(edge_rows)
    assert m.mix(no_docs).count() == 0 and m.apply_mix(no_docs).count() == 0


@pytest.mark.parametrize("slices", [1, 7, 4096])
def test_hot_source_and_slices(spark, monkeypatch, slices):
    monkeypatch.setattr(m, "SLICES", slices)
    rows = [(k, " ".join(["w"] * (1 + k * 7 % 23)) + ("!" * (k % 4)), None, ["hot", "hot", "b", "c", None, "d", "é"][k % 7], 0, 0, "", "", 0.0, 0) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, size string, _row string, features double, copies long")
    got = result(m.mix(docs))
    assert got == brute(rows)
    near = defaultdict(int)
    source = {r[0]: r[3] for r in rows}
    goal = {}
    for doc_id, size, _, target, taken in got:
        near[source[doc_id]] += taken
        goal[source[doc_id]] = target
        assert 0 <= taken <= 2 * size
    assert all(abs(near[s] - goal[s]) <= 23 for s in goal)
    assert result(m.mix(docs)) == got


def test_targets_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 5, "e": 400, None: 30}
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in m.targets(totals).collect()}
    want = brute_targets(sizes)
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_rows_of_the_mix(edge_docs, edge_rows):
    done = m.apply_mix(edge_docs)
    assert done.columns == edge_docs.columns and done.dtypes == edge_docs.dtypes
    got = Counter((r["doc_id"], r["text"]) for r in done.collect())
    words = Counter()
    for (doc_id, text), n in got.items():
        words[doc_id] += n * len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = Counter()
    for doc_id, _, _, _, taken in brute(edge_rows):
        want[doc_id] += taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in want.items() if v}


def test_native(edge_docs):
    for df in (m.mix(edge_docs), m.apply_mix(edge_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("of_one_place", [300, 1000])
def test_the_cut_among_equal_rows(spark, of_one_place):
    """The fractional epoch ends inside a group of equal rows, of which it takes a part."""
    rows = [(None, "the same three", None, None, 0, k, "", "", 0.0, 0) for k in range(of_one_place)]
    rows += [(7, "one more", None, "b", 0, k, "", "", 0.0, 0) for k in range(of_one_place - 300)]
    rows += [(k, "other " * (k % 5), None, "b", 0, k, "", "", 0.0, 0) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, size string, _row string, features double, copies long").repartition(5)
    want = brute(rows)
    assert result(m.mix(docs)) == want
    words, taken = Counter(), Counter()
    for r in m.apply_mix(docs).collect():
        words[r["doc_id"]] += len(r["text"].split())
    for doc_id, _, _, _, n in want:
        taken[doc_id] += n
    assert +words == +taken


def test_equal_rows_come_near_the_target(spark):
    rows = [(1, "a b", None, "s", 0, k, "", "", 0.0, 0) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, size string, _row string, features double, copies long").repartition(6)
    assert sum(r["taken"] for r in m.mix(docs).collect()) == 3000
    done = Counter(r["key"] for r in m.apply_mix(docs).collect())
    assert sorted(Counter(done.values()).items()) == [(1, 500), (2, 500)]


@pytest.mark.parametrize("slices, ordered", [(4096, 50), (7, 20), (1, 3)])
def test_low_qualities_crowd_the_last_slice(spark, monkeypatch, slices, ordered):
    """Most keys of mark-up lie in the last slice, which is cut again before it is ordered."""
    monkeypatch.setattr(m, "SLICES", slices)
    monkeypatch.setattr(m, "ORDERED", ordered)
    orderings, narrowed = [], m._narrowed
    monkeypatch.setattr(m, "_narrowed", lambda *a: orderings.append(narrowed(*a)) or orderings[-1])
    rows = [(k // 2 if k % 3 else k, "<b> " * (1 + k % 5), None, ["html", "html", "é", None][k % 4], 0, 0, "", "", 0.0, 0) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, size string, _row string, features double, copies long")
    assert result(m.mix(docs)) == brute(rows)
    assert max(r["count"] for r in orderings[0].groupBy("source").count().collect()) <= ordered
